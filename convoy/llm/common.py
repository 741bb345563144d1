"""Helpers shared by the operators: tables, tokens, folds, staged tables, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.session import materialize, workspace

#: The ASCII white space that separates words (space, and tab to carriage return).
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name (dots and spaces allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back."""
    if compression == "snappy":
        return materialize(df, name)[0]
    path = workspace(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, training: Column, sample: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text, label double): at most ``sample`` labelled rows, the smallest by a hash of their
    ids among the labels 0 or 1 for which ``training`` (over ``labels``) holds.

    Ids are chosen from the labels alone; the bounded list is broadcast to the documents, so no
    text is shuffled before the sample is drawn.  Of rows that repeat an id one is used."""
    chosen = (
        labels.where(training & col(label_col).isin(0, 1))
        .groupBy(col(id_col).alias("id"))
        .agg(F.max(col(label_col)).cast("double").alias("label"))
        .where("id is not null")
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    chosen = staged(chosen, "label_sample")
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("text").alias("text"), F.first("label").alias("label"))
    return staged(found.repartition(16, "id"), "labelled_texts")


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lowered; bytes.lower and bytes.split know ASCII only, so
    the separators are exactly space and tab to carriage return."""
    return text.lower().split() if text else []


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of an undirected graph, ``edges(a long, b long)`` -> (node, root)
    with root the smallest node reachable; only nodes with an edge to another node appear.

    Alternating large-star and small-star steps (each a minimum per node, combined map-side, and
    a join back that adaptive execution splits on a hub) until no edge changes.  After each
    round the edges are a table in the shared folder, so lost executors re-read files and the
    plan stays short; the number of rounds grows with the logarithm of the longest path.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = staged(e, name)
    before = None
    while True:
        # large star: link every larger neighbour of a node to the node's smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(low, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        # small star: link every smaller neighbour, and the node, to the smallest one
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        nxt = (
            large.join(small, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        e = staged(nxt, name)
        # a and b enter through hashes of different kinds, so a swap changes the sum
        now = e.agg(
            F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
        ).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
