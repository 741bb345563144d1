"""Order-dependent operators without a single-partition window.

A window ``ORDER BY seq`` with no ``PARTITION BY`` moves every row into one task.  Here the
ordering key (a unique integer, e.g. the file position or an order number) is cut into
fixed-width blocks, ``seq div block``:

1. per block: the block totals (a hash aggregate with map-side combine, one row per block);
2. per block: the exclusive prefix of the block totals, computed the same way one level up
   (the block totals are blocked again), so the only single-partition window sees at most
   ``key range / block**2`` rows;
3. per row: the running values inside its block (one window partitioned by block), plus the
   block's prefix.

A block holds at most ``block`` rows because the key is unique, so no task ever holds more
than that, whatever the data size.  Block ids come from the key itself, so a recomputed
task after an executor loss sees the same blocks.  Running sums and row numbers share the
same exchange, sort and window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from convoy.session import materialize

DEFAULT_BLOCK = 1 << 20


def accumulate(
    df: DataFrame,
    order_by: str,
    sums: dict[str, str] | None = None,
    row_number: str | None = None,
    block: int = DEFAULT_BLOCK,
    tiebreak: tuple[str, ...] = (),
    partition_by: tuple[str, ...] = (),
    _level: int = 0,
) -> DataFrame:
    """Add inclusive running sums (``{out: value}``) and/or a 1-based row number in ascending
    ``order_by`` (an integer key).  NULL values are skipped by the sums; the running sum of a
    row whose own value is NULL is NULL.

    The key should be unique; if it is not, pass ``tiebreak`` columns that make
    ``(order_by, *tiebreak)`` unique, otherwise the order among equal keys is arbitrary.  With
    duplicate keys a block can hold more than ``block`` rows (all rows of one key share a block).

    ``partition_by``: sums and numbers start anew in each group (NULL is a group of its own).  A group
    is cut into blocks like the whole, so one that holds a third of the rows spans many tasks; the
    last window holds ``key range / block**2`` rows of a group.
    """
    if not isinstance(df.schema[order_by].dataType, IntegralType):
        raise TypeError(f"accumulate needs an integer ordering key, {order_by} is {df.schema[order_by].dataType}")
    sums = dict(sums or {})
    blk = f"__blk{_level}"  # internal names carry the level: the next level orders by this one
    d = df.withColumn(blk, F.expr(f"cast(`{order_by}` AS bigint) div {int(block)}"))
    groups = [F.col(f"`{g}`") for g in partition_by]

    totals = [F.coalesce(F.sum(v), F.lit(0)).alias(f"__tot_{o}") for o, v in sums.items()]
    if row_number:
        totals.append(F.count(F.lit(1)).alias("__tot_rn"))
    names = [*sums, *([row_number] if row_number else [])]
    tot_cols = [f"__tot_{o}" for o in sums] + (["__tot_rn"] if row_number else [])
    per_block = d.groupBy(*groups, blk).agg(*totals)
    if _level == 0:
        # the prefix over the block totals is itself computed blocked (block ids are unique
        # integers), so the only single-partition window sees at most range / block**2 rows
        inclusive = accumulate(
            per_block, blk, sums={f"__inc_{n}": t for t, n in zip(tot_cols, names)}, block=block,
            partition_by=partition_by, _level=1,
        )
        offsets = inclusive.select(
            *groups, blk, *[(F.col(f"__inc_{n}") - F.col(t)).alias(f"__off_{n}") for t, n in zip(tot_cols, names)]
        )
    else:
        prior = Window.partitionBy(*groups).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_block.select(
            *groups,
            blk,
            *[F.coalesce(F.sum(t).over(prior), F.lit(0)).alias(f"__off_{n}") for t, n in zip(tot_cols, names)],
        )

    w = Window.partitionBy(*groups, blk).orderBy(order_by, *tiebreak)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    local = {f"__loc_{o}": F.coalesce(F.sum(v).over(running), F.lit(0)) for o, v in sums.items()}
    if row_number:
        local[f"__loc_{row_number}"] = F.row_number().over(w).cast("long")
    right = offsets.withColumnsRenamed({c: f"__of_{c}" for c in (*partition_by, blk)})
    same = F.col(blk).eqNullSafe(F.col(f"__of_{blk}")) if partition_by else F.col(blk) == F.col(f"__of_{blk}")
    for g in partition_by:
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"`__of_{g}`"))
    res = d.withColumns(local).join(right, same, "left")
    outs = {o: F.when(F.col(v).isNotNull(), F.col(f"__loc_{o}") + F.col(f"__off_{o}")) for o, v in sums.items()}
    if row_number:
        outs[row_number] = F.col(f"__loc_{row_number}") + F.col(f"__off_{row_number}")
    return res.withColumns(outs).select(*df.columns, *names)


def running_sum(df: DataFrame, value: str, order_by: str, out: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Inclusive running sum of ``value`` in ascending ``order_by`` (unique integer key)."""
    return accumulate(df, order_by, sums={out: value}, block=block)


def surrogate_key(df: DataFrame, order_by: str, out: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Row number 1..n in ascending ``order_by`` (unique integer key)."""
    return accumulate(df, order_by, row_number=out, block=block)


def number_rows(df: DataFrame, order_by: tuple[str, ...], out: str, partitions: int | None = None) -> DataFrame:
    """Row number 1..n in ascending order of any sortable columns (NULLs first).

    Rows are dealt into ranges whose bounds Spark samples (all columns of ``order_by`` take part,
    so a value of the first that a third of the rows share is split by the next), written once with the
    number of their range, counted per range, numbered inside it and moved by the ranges before.
    The written labels make the numbering safe against recomputed tasks; where ``order_by`` is a
    total order, the numbers do not depend on the sampled bounds, so reruns agree.  Rows equal in
    all of it are numbered in any order."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(f"`{c}`") for c in order_by]
    ranged, _ = materialize(df.repartitionByRange(n, *cols).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))  # one row a range
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = ranged.withColumn("__row", F.row_number().over(Window.partitionBy("__range").orderBy(*cols)))
    numbered = inside.join(F.broadcast(offsets), "__range")
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__row") + F.col("__before")).alias(out))
