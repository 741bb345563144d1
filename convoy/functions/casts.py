"""Casting, padding and flattening of whole schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def cast_columns(df: DataFrame, columns, to: str | DataType = "float", mode: str = "permissive") -> DataFrame:
    """Cast a list of columns in one projection; bad text becomes NULL unless ``mode="strict"``,
    which fails the job instead."""
    from convoy.functions.time import strict

    out = {}
    for c in columns:
        cast = F.col(c).try_cast(to)
        out[c] = strict(F.col(c), cast, str(to)) if mode == "strict" else cast
    return df.withColumns(out)


def pad_columns(df: DataFrame, like: StructType | DataFrame) -> DataFrame:
    """Project ``df`` onto the schema of ``like``: missing columns become typed NULLs, in order."""
    schema = like.schema if isinstance(like, DataFrame) else like
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def _flat_fields(schema: StructType, prefix: str = ""):
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        if isinstance(f.dataType, StructType):
            yield from _flat_fields(f.dataType, name + ".")
        else:
            yield name


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Flatten nested structs to top-level columns named ``a.b`` (arrays and maps are left whole)."""
    cols = []
    for path in _flat_fields(df.schema):
        parts = path.split(".")
        expr = F.col(f"`{parts[0]}`")
        for p in parts[1:]:
            expr = expr.getField(p)
        cols.append(expr.alias(sep.join(parts)))
    return df.select(*cols)
