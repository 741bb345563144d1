"""Line dedup: drop lines that many documents share.

Lines are exploded and normalised, hashed to 128 bits (two seeded XXH64), counted by distinct
document, and a line whose key reaches the threshold stays only in the largest document id that
holds it.  Only hashes and positions are shuffled for counting; the texts move once, to meet
their own list of dropped positions, and are reassembled by position with array functions.

Skew: the count first groups by (key, document), so a line held by a third of all documents is
combined map-side and counted in two steps; the join of lines with the repeated keys has one row
per key on one side, so adaptive execution may split or broadcast it.

Cases: NULL or empty text is one empty line.  NULL ids never count as a document and are never
the keeper.  Rows that repeat an id count as one document; identical rows give identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import LOWER, UPPER, WHITE, col, staged


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def _row_key(doc: Column, text: Column) -> list[Column]:
    return [F.xxhash64(doc, text).alias("__r1"), F.xxhash64(F.lit(1), doc, text).alias("__r2")]


def dropped_positions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """(__r1, __r2, __drops): the 0-based positions that each row loses; rows losing none are absent."""
    base = docs.select(col(id_col).alias("doc"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    lines = (
        base.select("doc", *_row_key(F.col("doc"), F.col("text")), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        .select("doc", "__r1", "__r2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    lines = staged(lines, "lines")
    # a table of its own, so that the join below reads two plain exchanges, which adaptive
    # execution can split at a hot key (an aggregate in the join's stage would forbid that)
    shared = staged(
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "keeper"),
        "shared_lines",
    )
    return (
        lines.join(shared, ["h1", "h2"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("__r1", "__r2")
        .agg(F.collect_set("pos").alias("__drops"))
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """The rows of ``docs`` with the text rebuilt from the kept lines, plus a struct column
    ``__lines`` (n_lines, n_dropped).  A text that keeps no line becomes the empty text."""
    drops = dropped_positions(docs, id_col, text_col, min_chars, min_docs)
    text = F.coalesce(col(text_col), F.lit(""))
    # the other columns travel as a struct, so none of them can clash with the names used here
    others = [c for c in docs.columns if c != text_col]
    keyed = docs.select(F.struct(*[col(c) for c in others]).alias("row"), text.alias("text"), *_row_key(col(id_col), text))
    # the drop lists are the small side: hash them, so the texts are not sorted
    joined = keyed.join(drops.hint("shuffle_hash"), ["__r1", "__r2"], "left")
    drop = F.coalesce(F.col("__drops"), F.array().cast("array<int>"))
    kept = F.when(F.col("__drops").isNull(), F.col("text")).otherwise(
        F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size("__all") - 1), drop), lambda i: F.get("__all", i)), "\n"
        )
    )
    return (
        joined.withColumn("__all", F.split("text", "\n", -1))
        .withColumn("__kept", kept)
        .withColumn("__lines", F.struct(F.size("__all").cast("long").alias("n_lines"), F.size(drop).cast("long").alias("n_dropped")))
        .select(*[(F.col("__kept").alias(c) if c == text_col else F.col("row")[c].alias(c)) for c in docs.columns], "__lines")
    )
