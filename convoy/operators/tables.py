"""Keyed, partitioned parquet tables with latest-row-wins semantics.

A table is described by a frozen ``TableSpec``: record key, ordering ("precombine") columns,
Hive-style partition columns and the key scope.  Writes are deterministic:

* ``dedupe_latest`` keeps, per key, the row with the largest ordering value; ties are broken
  by the remaining columns, so the same input always gives the same table.  It is a maximum
  over a struct (a sort aggregate, partial and final), so duplicates are combined map-side before the shuffle and
  a key holding a third of all rows never lands whole in one task.
* ``replace`` de-duplicates the batch and replaces the table: the new one is written beside it
  and renamed into place, so a write that fails midway leaves the old table as it was, and one
  that stops between the renames is completed when the table is next opened.
* ``upsert`` merges the batch into the table: the rows of the touched partitions (and, with
  ``scope="table"``, of the partitions where a batch key lived before) are merged with the
  batch, de-duplicated and written with dynamic partition overwrite, so untouched
  partitions are not rewritten.  A partition left empty by a key that moved away is removed.
  One writer per table at a time.

Layout: every write to partitions is dealt out by ranges of partition and key (a hot partition
value is split over several tasks by its rows) and sorted by them inside each file, so the parquet
min/max statistics of the key and ordering columns are tight for data skipping.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convoy.session import materialize, remove_path

META_FILE = "_convoy_table.json"  # ignored by parquet readers (leading underscore)


def _tuple(v) -> tuple[str, ...]:
    if v is None:
        return ()
    if isinstance(v, str):
        return tuple(x.strip() for x in v.split(",") if x.strip())
    return tuple(v)


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    partition_by: tuple[str, ...] = field(default=())
    scope: str = "table"  # "table": a key is unique in the table; "partition": per partition
    cluster_by: tuple[str, ...] = field(default=())  # sort order inside partitions (data skipping)

    def __post_init__(self):
        object.__setattr__(self, "keys", _tuple(self.keys))
        object.__setattr__(self, "order_by", _tuple(self.order_by))
        object.__setattr__(self, "partition_by", _tuple(self.partition_by))
        object.__setattr__(self, "cluster_by", _tuple(self.cluster_by))
        if not self.keys:
            raise ValueError("a table needs a record key")
        if self.scope not in ("table", "partition"):
            raise ValueError(f"unknown key scope {self.scope}")

    def with_partitions(self, partition_by, cluster_by=()) -> "TableSpec":
        return TableSpec(self.name, self.keys, self.order_by, partition_by, self.scope, cluster_by)

    @property
    def unique_by(self) -> tuple[str, ...]:
        """Columns that identify a row: the key, plus the partition with partition scope."""
        if self.scope == "partition":
            return self.keys + tuple(p for p in self.partition_by if p not in self.keys)
        return self.keys


def dedupe_latest(df: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the largest ``order_by`` value wins (NULLs lose); ties go to the
    largest remaining columns."""
    keys, order_by = _tuple(keys), _tuple(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = [c for c in order_by if c not in keys] + rest
    if not ranked:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in ranked])).alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in ranked]).select(*df.columns)


def _layout(df: DataFrame, spec: TableSpec) -> DataFrame:
    order = [*spec.partition_by, *spec.cluster_by, *spec.keys]
    if spec.cluster_by or spec.partition_by:
        # contiguous ranges per file (tight min/max statistics); the key is part of the range, so a
        # hot partition or cluster value is split across tasks by its rows, however few bytes
        # they compress to
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    return df.sortWithinPartitions(*spec.keys)


def _save(df: DataFrame, spec: TableSpec, path: str, dynamic: bool) -> None:
    w = _layout(df, spec).write.mode("overwrite")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    w.parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_meta(spark: SparkSession, spec: TableSpec, schema: StructType, path: str) -> None:
    """One small JSON file at the table root, written by the driver (no Spark job)."""
    meta = {
        "name": spec.name,
        "keys": list(spec.keys),
        "order_by": list(spec.order_by),
        "partition_by": list(spec.partition_by),
        "scope": spec.scope,
        "cluster_by": list(spec.cluster_by),
        "schema": json.loads(schema.json()),
    }
    p, fs = _fs(spark, f"{path.rstrip('/')}/{META_FILE}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(meta).encode("utf-8")))
    finally:
        out.close()


#: Names beside a table: the new one while it is written, the old one while they change places.
NEXT, OLD = ".__next", ".__old"


def _replace(df: DataFrame, spec: TableSpec, schema: StructType, path: str, verify: bool = False) -> None:
    """Write a whole table beside the one at ``path``, then let them change places.  The
    description is written last: it tells a complete table from one whose write failed.
    ``verify``: a key written twice fails the write before the tables change places."""
    spark, path = df.sparkSession, path.rstrip("/")
    _recover(spark, path)
    for rest in (NEXT, OLD):
        remove_path(spark, path + rest)
    _save(df, spec, path + NEXT, dynamic=False)
    if verify:
        _refuse_repeats(spark, spec, schema, path + NEXT)
    _write_meta(spark, spec, schema, path + NEXT)
    _move(spark, path, path + OLD)
    _move(spark, path + NEXT, path)
    remove_path(spark, path + OLD)


def _refuse_repeats(spark: SparkSession, spec: TableSpec, schema: StructType, path: str) -> None:
    """Raise if two written rows share a key.  Reads the key columns alone from the files just
    written and counts them with map-side combine, so a key that a third of the rows share is
    one row a task before the shuffle."""
    written = spark.read.schema(schema).parquet(path)
    keys = [F.col(f"`{c}`") for c in spec.unique_by]
    repeated = written.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").first()
    if repeated is not None:
        remove_path(spark, path)
        raise ValueError(f"the rows for {spec.name} are not unique by {', '.join(spec.unique_by)}: {tuple(repeated)[:-1]} comes {repeated['__n']} times")


def _move(spark: SparkSession, source: str, target: str) -> None:
    a, fs = _fs(spark, source)
    if fs.exists(a) and not fs.rename(a, _fs(spark, target)[0]):
        raise OSError(f"cannot rename {source} to {target}")


def _recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement that stopped while the tables changed places: nothing is at ``path``
    then, and the new table, which is complete, or the old one is beside it."""
    here, fs = _fs(spark, path)
    if fs.exists(here):
        return
    for beside in (NEXT, OLD):
        if fs.exists(_fs(spark, f"{path}{beside}/{META_FILE}")[0]):
            _move(spark, path + beside, path)
            return


def table_meta(spark: SparkSession, path: str) -> tuple[TableSpec, StructType] | None:
    path = path.rstrip("/")
    _recover(spark, path)
    p, fs = _fs(spark, f"{path}/{META_FILE}")
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        text = reader.readLine()
    finally:
        reader.close()
    meta = json.loads(text)
    spec = TableSpec(
        meta["name"], meta["keys"], meta["order_by"], meta["partition_by"], meta["scope"], meta.get("cluster_by", ())
    )
    return spec, StructType.fromJson(meta["schema"])


def read_table(spark: SparkSession, path: str, view: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Read a table with its declared schema and column order; optionally register a view."""
    if schema is None:
        found = table_meta(spark, path)  # completes a replacement that was stopped
        if found is None:
            raise FileNotFoundError(f"no table at {path}")
        schema = found[1]
    df = spark.read.schema(schema).parquet(path).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    if view:
        df.createOrReplaceTempView(view)
    return df


def write_table(
    df: DataFrame, spec: TableSpec, path: str, mode: str = "replace", assume_unique: bool = False, verify: bool = True
) -> str:
    """Write ``df`` as the table at ``path``: ``replace`` or ``upsert``; returns ``path``.

    ``assume_unique`` skips the latest-row-wins shuffle of a replace when the rows are unique by
    key by construction (a filter or projection of a keyed table, or an aggregate grouped by
    exactly the key).  The keys are counted once they are written, and a repeated one fails the
    write with the old table left as it was; ``verify=False`` skips that for rows copied from a
    table with the same key."""
    spark = df.sparkSession
    if mode == "replace":
        rows = df if assume_unique else dedupe_latest(df, spec.unique_by, spec.order_by)
        _replace(rows, spec, df.schema, path, verify=assume_unique and verify)
        return path
    if mode != "upsert":
        raise ValueError(f"unknown write mode {mode}")
    found = table_meta(spark, path)
    if found is None:
        where, fs = _fs(spark, path)
        if fs.exists(where) and fs.listStatus(where):
            raise ValueError(f"{path} holds files but no table description; replace it or restore the description")
        return write_table(df, spec, path, "replace")
    for part in ("keys", "order_by", "partition_by", "scope"):
        if getattr(found[0], part) != getattr(spec, part):
            raise ValueError(f"the table at {path} has {part} {getattr(found[0], part)}, not {getattr(spec, part)}")
    if set(df.columns) != set(found[1].names):
        raise ValueError(f"the table at {path} has columns {found[1].names}, not {df.columns}")
    return _upsert(spark, df, spec, path)


def _null_safe_on(left: str, right: str, cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return cond


def _upsert(spark: SparkSession, batch: DataFrame, spec: TableSpec, path: str) -> str:
    _, schema = table_meta(spark, path)
    existing = read_table(spark, path, schema=schema)
    batch = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    # the de-duplicated batch is staged once: every later step reads the same rows, and the
    # batch's own lineage (often a join) is not recomputed per step
    fresh, batch_path = materialize(dedupe_latest(batch, spec.unique_by, spec.order_by), "batch")
    if not spec.partition_by:
        merged = dedupe_latest(existing.unionByName(fresh), spec.unique_by, spec.order_by)
        _replace(merged, spec, schema, path)  # reads the old table while it writes the new one beside
        remove_path(spark, batch_path)
        return path

    parts = list(spec.partition_by)
    touched = fresh.select(*parts)
    homes = None
    if spec.scope == "table":
        # partitions a batch key lives in now: its row must leave them if it moved.  Only keys are
        # read, within the batch's key range (files are sorted by key, so statistics prune them)
        located = spark.read.schema(schema).parquet(path).select(
            *[F.col(f"`{c}`") for c in dict.fromkeys([*spec.keys, *parts])],
            F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("__dir"),
        )
        first = spec.keys[0]
        # scalar subqueries, so the bounds keep the column's own type and reach the parquet scan
        low, high = (fresh.agg(f(first)).scalar() for f in (F.min, F.max))
        located = located.where(F.col(f"`{first}`").between(low, high) | F.col(f"`{first}`").isNull())
        homes = located.alias("e").join(fresh.select(*spec.keys).alias("t"), _null_safe_on("e", "t", spec.keys), "left_semi")
        homes, homes_path = materialize(homes.select(*parts, "__dir").distinct(), "homes")
        touched = touched.unionByName(homes.select(*parts))
    touched, touched_path = materialize(touched.groupBy(*parts).agg(F.count("*").alias("__rows")), "touched")
    old = rows_of_partitions(existing, touched, parts)
    # the merged rows of the touched partitions, computed once and staged in the checkpoint
    # folder; the write and the emptied-partition check both read that copy, and the write
    # never reads the files it replaces
    merged, stage_path = materialize(dedupe_latest(old.unionByName(fresh), spec.unique_by, spec.order_by), "upsert")

    # a partition can only lose all its rows when a key moved out of it; such partitions are
    # not rewritten by a dynamic overwrite, so find their folders (by the files' own paths, at
    # most one per partition) and remove them after the write
    emptied = []
    if homes is not None:
        kept = merged.select(*parts).distinct()
        gone = homes.alias("h").join(kept.alias("k"), _null_safe_on("h", "k", parts), "left_anti")
        emptied = [r[0] for r in gone.select("__dir").distinct().collect()]

    _save(merged, spec, path, dynamic=True)
    for folder in emptied:
        remove_path(spark, folder, uri=True)
    for done in [stage_path, batch_path, touched_path] + ([homes_path] if homes is not None else []):
        remove_path(spark, done)
    return path


def rows_of_partitions(existing: DataFrame, touched: DataFrame, parts) -> DataFrame:
    """The rows of ``existing`` whose partition is in ``touched`` (partition columns, ``__rows``).

    Partitions without a NULL value join by plain equality on the columns' own types, which lets
    Spark prune the scan by the list it broadcasts (dynamic partition pruning; it asks for a
    selective filter on that side, hence the one on ``__rows``).  Partitions with a NULL value are
    found by a filter on the partition columns, which prunes the scan, and a null-safe join."""
    some_null = F.lit(False)
    for c in parts:
        some_null = some_null | F.col(f"`{c}`").isNull()
    named = touched.where("__rows > 0").where(~some_null).select(*parts)
    plain = existing.join(named, list(parts), "left_semi").select(*[F.col(f"`{c}`") for c in existing.columns])
    unnamed = touched.where(some_null).select(*parts)
    others = existing.where(some_null).alias("e").join(unnamed.alias("t"), _null_safe_on("e", "t", parts), "left_semi")
    return plain.unionByName(others)


def write_layouts(df: DataFrame, specs: dict[str, TableSpec], root: str) -> dict[str, str]:
    """Write the same rows once per layout.  The first layout is written from ``df``; the
    others are copied from it, so ``df`` (e.g. an interval join) is computed once and a lost
    executor re-reads files instead of recomputing the join."""
    paths: dict[str, str] = {}
    source = None
    for name, spec in specs.items():
        path = f"{root.rstrip('/')}/{name}"
        # copies of the first layout are unique by key already
        rows = df if source is None else source
        same_key = source is not None and spec.unique_by == next(iter(specs.values())).unique_by
        write_table(rows, spec, path, "replace", assume_unique=source is not None, verify=not same_key)
        if source is None:
            source = read_table(df.sparkSession, path)
        paths[name] = path
    return paths
