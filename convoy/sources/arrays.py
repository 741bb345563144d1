"""Scan of JSON files that hold arrays of records, split over tasks.

Spark's ``multiLine`` reader parses such a file in one task.  Here the files are read as text cut
at every ``}``, which splits anywhere, and the pieces are joined to records again:

1. A piece can begin inside a string or outside of one, which its own text does not tell.  Both
   cases are counted per piece: its quotes, and the braces it opens outside strings.
2. Per split (a range of a file, read whole by one task) a window adds these up for both cases; a
   window over one row per split then settles the case each split begins in, and its depth.
3. Pieces of a split between two closings at depth nought are one record.  Only the first and the
   last of a split can continue elsewhere; these ends alone are shuffled and joined by file and
   record number.

A task holds one split of text, and no step depends on the number of records in a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convoy.session import materialize

SPLIT = ["__file", "__block"]


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece: its split, place, text (without the ``}`` it ends at), quotes, and the
    braces it opens if it begins outside (``__open0``) or inside (``__open1``) a string."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # an escaped quote ends no string
    parts = F.split(plain, '"', -1)
    outside = F.array_join(F.filter(parts, lambda _, i: i % 2 == 0), "")
    inside = F.array_join(F.filter(parts, lambda _, i: i % 2 == 1), "")
    scanned = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
        F.col("value").alias("__text"),
        _count(plain, '"').alias("__quotes"),
        _count(outside, "{").alias("__open0"),
        _count(inside, "{").alias("__open1"),
    )
    return materialize(scanned, "array_pieces")[0]


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """The text of every record (``value``): each outermost ``{...}`` of the files under ``path``.
    What stands between records (brackets, commas, blanks) and a record the file never closes are left out."""
    pieces = _pieces(spark, path)
    place = Window.partitionBy(*SPLIT).orderBy("__id")
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    before = place.rowsBetween(Window.unboundedPreceding, -1)

    quoted = F.coalesce(F.sum("__quotes").over(before), F.lit(0))
    d = pieces.withColumn("__quoted", quoted)
    for s in (0, 1):
        inside = (F.col("__quoted") + s) % 2 == 1
        ends_inside = (F.col("__quoted") + F.col("__quotes") + s) % 2 == 1
        step = F.when(inside, F.col("__open1")).otherwise(F.col("__open0")) - F.when(ends_inside, 0).otherwise(1)
        d = d.withColumns({f"__step{s}": step, f"__ends{s}": ends_inside})
    d = d.withColumns({f"__depth{s}": F.sum(f"__step{s}").over(upto) for s in (0, 1)})

    # one row per split: the case it begins in, then its depth
    splits = d.groupBy(*SPLIT).agg(
        F.sum("__quotes").alias("__q"), *[F.sum(f"__step{s}").alias(f"__d{s}") for s in (0, 1)]
    )
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__case", F.coalesce(F.sum("__q").over(earlier), F.lit(0)) % 2)
    gained = F.when(F.col("__case") == 1, F.col("__d1")).otherwise(F.col("__d0"))
    splits = splits.withColumn("__base", F.coalesce(F.sum(gained).over(earlier), F.lit(0))).select(*SPLIT, "__case", "__base")

    d = d.join(splits, SPLIT)
    in_case = lambda name: F.when(F.col("__case") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    closes = ~in_case("__ends") & (in_case("__depth") + F.col("__base") == 0)
    d = d.withColumn("__closes", closes.cast("int"))
    d = d.withColumn("__record", F.coalesce(F.sum("__closes").over(before), F.lit(0)))
    runs = d.groupBy(*SPLIT, "__record").agg(
        F.array_sort(F.collect_list(F.struct("__id", "__text"))).alias("__run"),
        F.max("__closes").alias("__closed"),
    )
    text = F.concat(F.array_join(F.col("__run.__text"), "}"), F.lit("}"))
    runs, _ = materialize(runs.select(*SPLIT, "__record", "__closed", text.alias("__text")), "array_runs")

    # whole records, and the ends of splits, which meet under the record's number in the file
    end = ((F.col("__record") == 0) & (F.col("__block") > 0)) | (F.col("__closed") == 0)
    counts = runs.groupBy(*SPLIT).agg(F.sum("__closed").alias("__n"))
    counts = counts.select(*SPLIT, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    ends = runs.where(end).join(counts, SPLIT).groupBy("__file", (F.col("__first") + F.col("__record")).alias("__nth"))
    joined = ends.agg(
        F.array_sort(F.collect_list(F.struct("__block", "__text"))).alias("__run"), F.max("__closed").alias("__closed")
    )
    joined = joined.where("__closed = 1").select(F.array_join(F.col("__run.__text"), "").alias("__text"))
    found = runs.where(~end).select("__text").unionByName(joined)
    return found.select(F.regexp_replace("__text", r"^[^{]*", "").alias("value"))


def scan_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of JSON files that each hold arrays of them, a file over as many tasks as it has
    splits.  Rows equal those of ``scan_json(..., multiline=True)`` with the same schema; a record
    that does not convert has NULL columns.  An empty array has no rows."""
    parsed = array_records(spark, path).select(F.from_json("value", schema).alias("__rec"))
    return parsed.select("__rec.*")
