"""Typed ingest of text columns with a reject channel.

``typed_with_rejects`` converts text columns in one projection.  In permissive mode a value
that had text but does not parse becomes NULL in the typed rows, and the row is also listed
in the rejects (with the names of the columns that failed), so bad input is visible instead
of silently turning into NULLs.  In strict mode the first bad value fails the job.  Lines with
too many or too few fields (``files.scan_csv(malformed=...)``) are rejects too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.time import TIMESTAMP_PATTERN, parse_date, parse_timestamp, strict
from convoy.session import materialize


def _convert(c: str, kind: str, pattern: str | None, mode: str) -> Column:
    if kind == "timestamp":
        return parse_timestamp(c, pattern or TIMESTAMP_PATTERN, mode)
    if kind == "date":
        return parse_date(c, pattern or TIMESTAMP_PATTERN, mode)
    cast = F.col(c).try_cast(kind)
    return strict(F.col(c), cast, kind) if mode == "strict" else cast


def typed_with_rejects(
    df: DataFrame,
    conversions: dict[str, tuple[str, str | None]],
    mode: str = "permissive",
    malformed: str | None = None,
    stage: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``conversions``: column -> (type or "timestamp"/"date", optional pattern).

    Returns (typed rows, rejects).  Rejects keep the original text columns plus
    ``rejected_columns`` (array of the column names whose text did not convert).  The column
    ``malformed``, if named, holds the whole line of a row with a wrong number of fields, else
    NULL: such rows are rejects as well (strict mode fails), and only rejects keep the column.

    ``stage``: parse the text once, into a staged table of that name which both results are
    read from; otherwise each result parses it for itself (and Spark refuses a query that reads
    ``malformed`` alone from CSV)."""
    converted = {f"__typed_{c}": _convert(c, kind, pattern, mode) for c, (kind, pattern) in conversions.items()}
    d = df.withColumns(converted)
    failed = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & F.col(f"__typed_{c}").isNull(), F.lit(c)
                )
                for c in conversions
            ]
        )
    )
    d = d.withColumn("__failed", failed)
    if malformed and mode == "strict":
        whole = F.col(f"`{malformed}`")
        d = d.where(F.when(whole.isNull(), True).otherwise(F.raise_error(F.concat(F.lit("wrong number of fields: "), whole))))
    if stage:
        d, _ = materialize(d, stage)
    typed = d.select(
        *[
            F.col(f"__typed_{c}").alias(c) if c in conversions else F.col(f"`{c}`")
            for c in df.columns
            if c != malformed
        ]
    )
    bad = F.size("__failed") > 0
    if malformed:
        bad = bad | F.col(f"`{malformed}`").isNotNull()
    rejects = d.filter(bad).select(*[F.col(f"`{c}`") for c in df.columns], F.col("__failed").alias("rejected_columns"))
    return typed, rejects
