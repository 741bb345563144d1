"""File scans and sinks.

Every scan takes an explicit schema where the source has one, so nothing is inferred at run
time (inference is a full extra pass over the data and differs between files).  CSV without a
schema reads all columns as text, which the typed ingest then casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from convoy.session import materialize


def scan_json(spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = False) -> DataFrame:
    """JSON records.  ``multiline=True`` reads files that each hold one array of records
    (one task per file; ``arrays.scan_json_array`` splits them); JSON Lines (the default)
    splits large files across tasks."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def scan_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, malformed: str | None = None
) -> DataFrame:
    """CSV with a header line; without a schema every column is text.  Empty fields are NULL.

    A line with too few fields is padded with NULLs and one with too many is cut.  ``malformed``
    names one more column, which holds the whole line where that happened (or a typed field did
    not convert) and NULL elsewhere.  All fields are parsed for it, whichever columns are read."""
    r = spark.read.option("header", True)
    if malformed:
        fields = r.csv(path).schema if schema is None else schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        schema = StructType([*fields.fields, StructField(malformed, StringType())])
        r = r.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def in_file_order(scanned: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows of a file scan with their position 1..n in the files (files in path order).

    The rows are staged with the split they came from; a split lies whole in one task, in file
    order, so a position is the rows of all earlier splits plus the place in its own split.  The
    window runs over one row per split."""
    split = ["__file", "__block"]
    staged, _ = materialize(
        scanned.select(
            "*",
            F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__id"),
        ),
        "file_rows",
    )
    splits = staged.groupBy(*split).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = F.sum("__n").over(Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select(*split, "__first", F.coalesce(earlier, F.lit(0)).alias("__before"))
    position = F.col("__before") + F.col("__id") - F.col("__first") + 1
    return staged.join(splits, split).select(*[F.col(f"`{c}`") for c in scanned.columns], position.alias(seq))


def scan_csv_typed(spark: SparkSession, path: str, schema: StructType | str, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with a header and a declared schema; malformed values are NULL in ``PERMISSIVE``
    mode and fail the job in ``FAILFAST``."""
    return spark.read.option("header", True).option("mode", mode).schema(schema).csv(path)


def scan(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """Scan by format name (parquet, json, csv, orc, text ...)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def scan_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return scan(spark, path, "parquet", schema)


def sink_csv(df: DataFrame, path: str) -> str:
    """CSV with a header line; zone-free timestamps keep their microseconds."""
    w = df.write.mode("overwrite").option("header", True)
    w.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return path


def sink_csv_lines(lines: DataFrame, path: str, header: str) -> str:
    """Ready CSV lines (one text column), as they are, below the line ``header`` in every file: the
    header is the column's name, and nothing is quoted or parted."""
    line = lines.toDF(header)
    line.write.mode("overwrite").options(header=True, sep="\x01", quote="", escape="\x02").csv(path)
    return path


def millis(df: DataFrame) -> DataFrame:
    """Cut every timestamp column to milliseconds, keeping its type (zone-free stays zone-free)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_trunc("MILLISECOND", c).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def sink_parquet_ms(df: DataFrame, path: str) -> str:
    """Parquet with timestamps coerced to milliseconds."""
    millis(df).write.mode("overwrite").parquet(path)
    return path


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` placeholders are bound to the DataFrames passed by name, so no
    session-global view is needed (``createOrReplaceTempView`` remains available)."""
    return spark.sql(query, **frames) if frames else spark.sql(query)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
