"""Interval joins: points (samples) that fall inside closed intervals (delivery windows).

Spark has no range join.  A plain ``equi AND between`` join keeps the range test as a
residual inside an equi join on the entity key, so every interval probes *all* points of its
entity, parallelism is capped by the number of entities and one hot entity lands in one task.

``interval_join`` turns the range into equi keys instead:

* a point gets the time bucket it falls in: ``floor(t / width)``;
* an interval is exploded into the buckets it touches: ``sequence(bucket(start), bucket(end))``;
* both sides are joined on ``(entity keys..., level, bucket)`` and the closed-interval test
  stays as a residual.

Every point sits in exactly one bucket per level, so no pair is produced twice.  Each interval
probes only ``(duration + width) * rate`` points and a hot entity is spread over its buckets.
Long intervals are never cut or dropped: the bucket width is multiplied by ``fanout`` per extra
level until every interval spans at most ``fanout`` buckets of its own level, and points are
replicated once per level in use (normally one).  The levels come from one aggregate over
the intervals (a single row to the driver).

The bucket width comes from the data unless the caller names one, see ``derive_buckets``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, NumericType, TimestampNTZType, TimestampType

from convoy.functions.time import timestamp_micros_sql
from convoy.session import materialize

_SECOND_US = 1_000_000


def _kind(*types) -> str:
    """The common kind of interval bounds and points.  Dates compare as their midnight with
    timestamps; zoned and zone-free timestamps have no order without a session zone, so they
    (and time with numbers) do not mix."""
    kinds = set()
    for dt in types:
        for known, kind in ((TimestampNTZType, "ntz"), (TimestampType, "zoned"), (DateType, "date"), (NumericType, "number")):
            if isinstance(dt, known):
                kinds.add(kind)
                break
        else:
            raise TypeError(f"interval bounds of type {dt} are not supported")
    if len(kinds) == 2 and "date" in kinds and "number" not in kinds:
        kinds.discard("date")
    if len(kinds) != 1:
        raise TypeError(f"interval bounds and points of different kinds: {sorted(kinds)}")
    return kinds.pop()


def _ordinal(schema, name: str, kind: str) -> tuple[str, float]:
    """SQL text of a monotone number that stands for a column of the kind, and its units per
    second; equal values of any column of the kind have equal numbers."""
    dt = schema[name].dataType
    c = f"`{name}`"
    if kind == "ntz":
        if isinstance(dt, DateType):
            return f"(cast(unix_date({c}) AS bigint) * 86400000000L)", _SECOND_US
        return timestamp_micros_sql(name), _SECOND_US
    if kind == "zoned":
        return f"unix_micros(cast({c} AS timestamp))", _SECOND_US
    if kind == "date":
        return f"cast(unix_date({c}) AS bigint)", 1 / 86_400
    if isinstance(dt, IntegralType):
        return c, 1
    # fractions: as doubles, and within the span of the coarsest bucket (open ends are infinite)
    return f"greatest(least(cast({c} AS double), 4e18D), -4e18D)", 1


def _widths(width: int, fanout: int) -> list[int]:
    """Bucket widths per level, coarser by ``fanout`` each, until one level covers any span a
    64-bit ordinal can hold (at most a handful of levels)."""
    widths = [width]
    while widths[-1] * (fanout - 1) < 2**63 and widths[-1] * fanout < 2**62:
        widths.append(widths[-1] * fanout)
    return widths


class Buckets(NamedTuple):
    """Width of the time buckets; ``single_level``: every interval fits the finest level;
    ``plain``: the unbucketed join of these inputs costs less."""

    seconds: float
    single_level: bool = False
    plain: bool = False


#: Cost of one exploded interval row (shuffled and sorted), in residual range tests (measured).
ROW_COST = 50
#: What bucketing a row costs against leaving it as it is (explode, wider key, sort), in range tests
#: of a plain join (measured).
BUCKET_ROW_COST = 1000
#: Range tests that one task of a plain join may be left with: a few seconds of a core.
PLAIN_TASK_TESTS = 100_000_000
#: Rows of one bucket that stay in one lane, and the most buckets looked up as hot ones.
LANE_ROWS = 100_000
HOT_BUCKETS = 1000
#: Moments of a bucket whose sums are joined: two more tested a point of width, against a row more for each halving.
MOMENTS = 36


def derive_buckets(
    intervals: DataFrame, points: DataFrame, *, start: str, end: str, at: str, on: Sequence[str] = (), fanout: int = 64
) -> Buckets:
    """The width that costs least for these inputs.

    An interval of length W against r points per second of its entity costs about
    ``ROW_COST * (W / b + 1)`` for its bucket rows and ``r * (W + b)`` range tests, least at
    ``b = sqrt(ROW_COST * W / r)``.  W is the median length; r is weighted by points (the rate that a
    point sees), so an entity that holds a third of the points narrows the buckets.  One job,
    two column-pruned aggregates, one row to the driver.
    """
    figures, unit = _figures(intervals, points, start, end, at, list(on))
    return _derived(figures, unit, bool(on), fanout)


def _figures(intervals, points, start, end, at, on):
    """The lengths of the intervals (``iv``) and the rate and span of the points (``pt``) as one row, and the
    units of the bounds' numbers per second."""
    kind = _kind(intervals.schema[start].dataType, intervals.schema[end].dataType, points.schema[at].dataType)
    lo, unit = _ordinal(intervals.schema, start, kind)
    hi, _ = _ordinal(intervals.schema, end, kind)
    t, _ = _ordinal(points.schema, at, kind)
    length = F.expr(f"cast({hi} AS double) - cast({lo} AS double)").alias("length")
    lengths = intervals.where(f"`{start}` <= `{end}`").select(length).agg(
        F.struct(
            F.percentile_approx("length", 0.5, 1000).alias("mid"),
            F.max("length").alias("top"),
            F.count(F.lit(1)).cast("double").alias("n"),
        )
    )
    per_entity = points.where(f"`{at}` IS NOT NULL").groupBy(*on).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.min(F.expr(f"cast({t} AS double)")).alias("lo"),
        F.max(F.expr(f"cast({t} AS double)")).alias("hi"),
    )
    rate = per_entity.agg(
        F.struct(
            (F.sum(F.col("n") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0.0))).alias("n"),
            (F.max("hi") - F.min("lo")).alias("span"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.max("n").alias("fullest"),
            F.sum("n").alias("all"),
        )
    )
    figures = intervals.sparkSession.range(1).select(lengths.scalar().alias("iv"), rate.scalar().alias("pt")).first()
    return figures, unit


def _derived(row, unit: float, keyed: bool, fanout: int) -> Buckets:
    mid, top = (row["iv"]["mid"] or 0.0), (row["iv"]["top"] or 0.0)
    n, span = (row["pt"]["n"] or 0.0), (row["pt"]["span"] or 0.0)
    if not n or not span:
        return Buckets(3600.0)
    # not wider than all the points and a median interval: one bucket would hold everything
    width = min(math.sqrt(ROW_COST * max(mid, 1.0) * span / n), span + mid)
    width = max(width, 1.0)
    count, fullest, points_n = row["iv"]["n"], row["pt"]["fullest"], row["pt"]["all"]
    bucketed_rows = count * (mid / width + 1) + points_n
    # the fullest entity is taken to have the same share of the intervals as of the points
    one_task = count * fullest / points_n * fullest
    plain = keyed and count * n <= BUCKET_ROW_COST * bucketed_rows and one_task <= PLAIN_TASK_TESTS
    return Buckets(width / unit, top / width + 2 < fanout, plain)


def interval_join(
    intervals: DataFrame,
    points: DataFrame,
    *,
    start: str,
    end: str,
    at: str,
    on: Sequence[str] = (),
    bucket_seconds: float | Buckets | None = None,
    fanout: int = 64,
    method: str = "auto",
    salt: int = 1,
    lane_rows: int | None = None,
) -> DataFrame:
    """Inner join of each interval with every point where ``start <= at <= end`` (both ends
    inclusive) and the ``on`` keys are equal.

    ``bucket_seconds`` is the bucket width; by default it is derived from the data (one small job).

    ``salt > 1`` splits every (key, bucket) into ``salt`` lanes: a point goes to one lane by
    hash, each bucketed interval to all lanes.  ``lane_rows`` does so for hot buckets alone: those with
    more points or more intervals than that are found by a sketch and split, see ``hot_buckets``.
    Use them when adaptive skew handling is not available; the result is the same.

    Returns all interval columns and all point columns except the point copies of ``on``.
    NULL keys or bounds never match; an interval with ``start > end`` matches nothing.
    ``method="bucket"`` always buckets, ``"plain"`` never does (an equi + range join, needs ``on``);
    ``"auto"`` takes the plain join where the width is derived and the same figures say it is cheaper.
    With a given width the plan is lazy: the bucket levels in use are a scalar subquery.
    """
    on = list(on)
    clash = (set(intervals.columns) & set(points.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides of the interval join: {sorted(clash)}")
    p = points.withColumnsRenamed({k: f"__p_{k}" for k in on})

    if method not in ("auto", "bucket", "plain"):
        raise ValueError(f"unknown method {method}")
    if bucket_seconds is None and method != "plain":
        bucket_seconds = derive_buckets(intervals, points, start=start, end=end, at=at, on=on, fanout=fanout)
        if method == "auto" and bucket_seconds.plain and salt == 1 and lane_rows is None:
            method = "plain"
    if method == "plain":
        if not on:
            raise ValueError("plain interval join needs equi keys (it would be a cross join)")
        keys = [intervals[k] == p[f"__p_{k}"] for k in on]
        in_range = (p[at] >= intervals[start]) & (p[at] <= intervals[end])
        out_cols = [intervals[c] for c in intervals.columns] + [p[c] for c in points.columns if c not in on]
        return intervals.join(p, keys + [in_range], "inner").select(*out_cols)
    return _bucketed(intervals, p, points.columns, start, end, at, on, bucket_seconds, fanout, salt=salt, lane_rows=lane_rows)


def hot_buckets(iv: DataFrame, pt: DataFrame, lane_rows: int = LANE_ROWS) -> DataFrame | None:
    """(key, point_lanes, interval_lanes) of the buckets that hold more than ``lane_rows`` rows of a
    side, None where there is none.  ``iv`` and ``pt`` have the bucket's hash in ``__key``.

    Each side's heavy hitters come from a frequent-items sketch, merged over the tasks (one job, no
    shuffle of rows); a lane then holds about ``lane_rows`` rows.  At most ``HOT_BUCKETS`` of a side are
    looked up, so the table is small enough to broadcast at any size of the input; with so
    many, each of the rest holds less than a thousandth of the rows and is left to adaptive
    execution; copies of one row share a lane.  A wrong count, or two buckets of one hash, changes the number of lanes only.
    """
    def top(side):
        return side.agg(F.expr(f"approx_top_k(__key, {HOT_BUCKETS}, {10 * HOT_BUCKETS})").alias("top")).scalar()

    spark = pt.sparkSession
    row = spark.range(1).select(top(pt).alias("pt"), top(iv).alias("iv")).first()
    lanes: dict[int, list[int]] = {}
    for side, found in enumerate((row["pt"], row["iv"])):
        for item in found or []:
            if item["count"] > lane_rows:
                lanes.setdefault(item["item"], [1, 1])[side] = math.ceil(item["count"] / lane_rows)
    if not lanes:
        return None
    rows = [(key, a, b) for key, (a, b) in sorted(lanes.items())]
    return spark.createDataFrame(rows, "key long, point_lanes int, interval_lanes int").coalesce(1)


def _laned(iv: DataFrame, pt: DataFrame, on: Sequence[str], lane_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with lanes (``__i_a``, ``__i_b`` and ``__p_a``, ``__p_b``) in their hot buckets: the lanes are a grid,
    a point keeps its row and is in all columns, an interval keeps its column and is in all rows."""
    iv = iv.withColumn("__key", F.xxhash64("__i_lvl", "__i_bkt", *[F.col(f"`{k}`") for k in on]))
    pt = pt.withColumn("__key", F.xxhash64("__p_lvl", "__p_bkt", *[F.col(f"`__p_{k}`") for k in on]))
    hot = hot_buckets(iv, pt, lane_rows)
    if hot is None:
        return None

    def lanes(side, own, other, own_lane, other_lane):
        found = side.join(F.broadcast(hot.withColumnRenamed("key", "__key")), "__key", "left")
        # the whole row (maps have no hash), so that equal moments spread, too
        place = F.xxhash64(*[F.col(f"`{f.name}`") for f in side.schema.fields if "map<" not in f.dataType.simpleString()])
        found = found.withColumn(own_lane, F.coalesce(F.pmod(place, F.col(own)).cast("int"), F.lit(0)))
        found = found.withColumn(other_lane, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)))
        return found.drop("__key", own, other)

    return (
        lanes(iv, "interval_lanes", "point_lanes", "__i_b", "__i_a"),
        lanes(pt, "point_lanes", "interval_lanes", "__p_a", "__p_b"),
    )


def _bucketed(intervals, p, point_columns, start, end, at, on, bucket_seconds, fanout, how="inner", salt=1, lane_rows=None):
    """The bucketed inner join (``p`` has its ``on`` columns renamed to ``__p_<name>``)."""
    valid = " AND ".join(
        [f"`{start}` IS NOT NULL", f"`{end}` IS NOT NULL", f"`{start}` <= `{end}`"]
        + [f"`{k}` IS NOT NULL" for k in on]
    )
    iv = intervals.filter(valid)

    ischema = intervals.schema
    kind = _kind(ischema[start].dataType, ischema[end].dataType, p.schema[at].dataType)
    lo, unit = _ordinal(ischema, start, kind)
    hi, _ = _ordinal(ischema, end, kind)
    buckets = bucket_seconds if isinstance(bucket_seconds, Buckets) else Buckets(bucket_seconds)
    width = max(1, int(round(buckets.seconds * unit)))
    widths = [width] if buckets.single_level else _widths(width, fanout)
    width_of = "array(" + ", ".join(f"{w}L" for w in widths) + ")"

    # the finest level on which the interval spans at most `fanout` buckets
    level = "CASE " + " ".join(
        f"WHEN floor({hi} / {w}L) - floor({lo} / {w}L) < {fanout} THEN {i}" for i, w in enumerate(widths[:-1])
    ) + f" ELSE {len(widths) - 1} END" if len(widths) > 1 else "0"
    iv = iv.withColumn("__i_lvl", F.expr(f"cast({level} AS int)"))
    # levels in use (a handful of values at most): points are bucketed once per level in use,
    # which is a single level unless some interval is more than `fanout` buckets long
    in_use = None if len(widths) == 1 else iv.select(F.collect_set("__i_lvl").alias("l")).scalar()
    w_iv = f"element_at({width_of}, __i_lvl + 1)"
    iv = iv.withColumn("__i_bkt", F.expr(f"explode(sequence(floor({lo} / {w_iv}), floor({hi} / {w_iv})))"))

    pt = p.filter(" AND ".join([f"`{at}` IS NOT NULL"] + [f"`__p_{k}` IS NOT NULL" for k in on]))
    t, _ = _ordinal(p.schema, at, kind)
    if in_use is None:
        pt = pt.withColumn("__p_lvl", F.lit(0))
    else:
        all_levels = F.expr("array(" + ", ".join(str(i) for i in range(len(widths))) + ")")
        pt = pt.withColumn("__p_lvl", F.explode(F.array_intersect(all_levels, in_use)))
    pt = pt.withColumn("__p_bkt", F.expr(f"floor({t} / element_at({width_of}, __p_lvl + 1))"))

    in_range = lambda iv, pt: (pt[at] >= iv[start]) & (pt[at] <= iv[end])
    iv, pt, cond = _on_buckets(iv, pt, at, on, in_use is not None, in_range, salt, lane_rows)
    out = [iv[c] for c in intervals.columns] + [pt[c] for c in point_columns if c not in on]
    return iv.join(pt, cond, how).select(*out)


def _on_buckets(iv, pt, at, on, levels, in_range, salt, lane_rows):
    """Both sides with the lanes they need, and the condition that joins them on keys, level (if there are
    ``levels``), bucket and lanes, and ``in_range``."""
    if salt > 1:
        iv = iv.withColumn("__i_salt", F.explode(F.sequence(F.lit(0), F.lit(int(salt) - 1))))
        pt = pt.withColumn("__p_salt", F.expr(f"pmod(hash(`{at}`, __p_bkt), {int(salt)})"))
    laned = _laned(iv, pt, on, lane_rows) if lane_rows else None
    if laned:
        iv, pt = laned

    cond = [iv[k] == pt[f"__p_{k}"] for k in on]
    if levels:
        cond.append(iv["__i_lvl"] == pt["__p_lvl"])
    cond.append(iv["__i_bkt"] == pt["__p_bkt"])
    if salt > 1:
        cond.append(iv["__i_salt"] == pt["__p_salt"])
    if laned:
        cond += [iv["__i_a"] == pt["__p_a"], iv["__i_b"] == pt["__p_b"]]
    return iv, pt, [*cond, in_range(iv, pt)]


def interval_averages(
    intervals: DataFrame,
    points: DataFrame,
    *,
    start: str,
    end: str,
    at: str,
    on: Sequence[str],
    measures: Sequence[str],
    bucket_seconds: float | Buckets | None = None,
    fanout: int = 64,
    method: str = "auto",
    salt: int = 1,
    lane_rows: int | None = None,
) -> DataFrame:
    """``interval_join(...)`` grouped by all interval columns, with the mean of each measure; arguments and
    methods as there.  Decimal measures are averaged from the pairs themselves.

    The mean is taken over the join without a row per pair.  Points of one moment, then those of a time
    bucket are added up before they are joined.  An interval reads single moments, with the closed-interval test, in
    the two buckets where it begins and ends only; buckets it holds whole give their sums.  Sums
    add up and are never subtracted, so NaN, infinities and large values stay in the intervals that hold them.

    ``"bucket"``: buckets of buckets, each twice as wide as the level below, so that an interval of n buckets
    joins about log2(n) sums by key, level and bucket; ``salt`` and ``lane_rows`` split those as they do for pairs.
    ``"plain"``: an equi + range join of intervals with the sums of buckets, and one with the moments of
    end buckets; its range tests per interval grow with the root of an entity's points.
    ``"auto"``: the pairs of a plain join where the derived figures say that it is cheaper, else buckets.
    """
    on, measures = list(on), list(measures)
    if method not in ("auto", "bucket", "plain"):
        raise ValueError(f"unknown method {method}")
    columns = list(dict.fromkeys([*on, at, *measures]))
    options = dict(start=start, end=end, at=at, on=on, bucket_seconds=bucket_seconds, fanout=fanout, salt=salt, lane_rows=lane_rows)

    def from_pairs(how):
        pairs = interval_join(intervals, points.select(*columns), method=how, **options)
        return pairs.groupBy(*intervals.columns).agg(*[F.avg(m).alias(m) for m in measures])

    if not on or any(isinstance(points.schema[m].dataType, DecimalType) for m in measures):
        return from_pairs(method)
    clash = set(intervals.columns) & {at, *measures}
    if clash:
        raise ValueError(f"columns on both sides of the interval join: {sorted(clash)}")

    row, unit = _figures(intervals, points, start, end, at, on)
    buckets = _derived(row, unit, True, fanout) if bucket_seconds is None else bucket_seconds
    if method == "auto" and bucket_seconds is None and buckets.plain and salt == 1 and lane_rows is None:
        return from_pairs("plain")
    kind = _kind(intervals.schema[start].dataType, intervals.schema[end].dataType, points.schema[at].dataType)
    lo, _ = _ordinal(intervals.schema, start, kind)
    hi, _ = _ordinal(intervals.schema, end, kind)
    t, _ = _ordinal(points.schema, at, kind)
    width = max(1, int(round((buckets.seconds if isinstance(buckets, Buckets) else buckets) * unit)))
    n, span = (row["pt"]["n"] or 0.0), (row["pt"]["span"] or 0.0)
    if bucket_seconds is None and n and span:
        # points of an end bucket against rows of sums: see MOMENTS; the plain join halves the sum of both
        per_bucket = math.sqrt(n / 2) if method == "plain" else MOMENTS
        width = max(1, min(width, math.ceil(per_bucket * span / n)) if method != "plain" else math.ceil(per_bucket * span / n))
    # buckets that hold points, one more at either end: what lies beyond joins nothing
    first, last = (math.floor((row["pt"][c] or 0.0) / width) + step for c, step in (("lo", -1), ("hi", 1)))

    # moments: count and sum of each measure, and those of buckets
    valid = F.col(f"`{at}`").isNotNull()
    for k in on:
        valid = valid & F.col(f"`{k}`").isNotNull()
    keys = [f"__p_{k}" for k in on]
    pt = points.where(valid).select(
        *[F.col(f"`{k}`").alias(p) for k, p in zip(on, keys, strict=True)], F.col(f"`{at}`"),
        F.expr(f"floor({t} / {width}L)").alias("__p_bkt"),
        *[F.col(f"`{m}`").cast("double").alias(f"__m{i}") for i, m in enumerate(measures)],
    )
    values = [v for i in range(len(measures)) for v in (f"__n{i}", f"__s{i}")]
    added = [F.sum(v).alias(v) for v in values]
    first_sums = [a for i in range(len(measures)) for a in (F.count(f"__m{i}").alias(f"__n{i}"), F.sum(f"__m{i}").alias(f"__s{i}"))]
    moments = pt.groupBy(*keys, "__p_bkt", at).agg(*first_sums)
    sums = moments.groupBy(*keys, "__p_bkt").agg(*added)

    held = F.col(f"`{start}`") <= F.col(f"`{end}`")
    for k in on:
        held = held & F.col(f"`{k}`").isNotNull()
    bound = lambda x: F.expr(f"greatest(least(floor({x} / {width}L), {last}L), {first}L)")
    iv = intervals.where(held).select(*on, start, end).distinct().withColumns({"__lo": bound(lo), "__hi": bound(hi)})
    window = [*on, start, end]
    if method == "plain":
        inner = interval_join(
            iv.withColumns({"__from": F.col("__lo") + 1, "__to": F.col("__hi") - 1}), sums.withColumnsRenamed(dict(zip(keys, on, strict=True))),
            start="__from", end="__to", at="__p_bkt", on=on, method="plain",
        )
        ends = iv.withColumn("__bkt", F.explode(F.array_distinct(F.array("__lo", "__hi"))))
        outer = interval_join(
            ends, moments.withColumnsRenamed({**dict(zip(keys, on, strict=True)), "__p_bkt": "__bkt"}),
            start=start, end=end, at=at, on=[*on, "__bkt"], method="plain",
        )
        parts = inner.select(*window, *values).unionByName(outer.select(*window, *values))
    else:
        inside = max(1, min(int((row["iv"]["top"] or 0.0) / width) + 2, last - first + 1))
        top = max(0, inside.bit_length() - 1)  # levels of sums are 1 + the power of two of their width
        # the ends of what is left to cover on a level; odd first and even last nodes have no parent inside
        iv = iv.withColumn("__i_lvl", F.explode(F.sequence(F.lit(0), F.lit(top + 1))))
        iv = iv.withColumns({
            "__a": F.expr("-shiftright(-(__lo + 1), greatest(__i_lvl - 1, 0))"), "__z": F.expr("shiftright(__hi, greatest(__i_lvl - 1, 0)) - 1"),
        })
        iv = iv.withColumn("__i_bkt", F.explode(F.expr(
            "CASE WHEN __i_lvl = 0 THEN array_distinct(array(__lo, __hi)) WHEN __a > __z THEN cast(array() AS array<bigint>) "
            f"WHEN __i_lvl = {top + 1} THEN sequence(__a, __z) "
            "ELSE array_compact(array(CASE WHEN __a % 2 <> 0 THEN __a END, CASE WHEN __z % 2 = 0 THEN __z END)) END"
        ))).select(*window, "__i_lvl", "__i_bkt")
        by_level = sums.withColumn("__p_lvl", F.explode(F.sequence(F.lit(1), F.lit(top + 1))))
        by_level = by_level.withColumn("__p_bkt", F.expr("shiftright(__p_bkt, __p_lvl - 1)")).groupBy(*keys, "__p_lvl", "__p_bkt").agg(*added)
        rows = moments.withColumn("__p_lvl", F.lit(0)).unionByName(by_level, allowMissingColumns=True)
        in_range = lambda iv, pt: (iv["__i_lvl"] > 0) | ((pt[at] >= iv[start]) & (pt[at] <= iv[end]))
        iv, rows, cond = _on_buckets(iv, rows, at, on, True, in_range, salt, lane_rows)
        parts = iv.join(rows, cond).select(*[iv[c] for c in window], *[rows[v] for v in values])

    found = parts.groupBy(*window).agg(*added)
    named = found.select(
        *[F.col(f"`{c}`").alias(f"__w{i}") for i, c in enumerate(window)],
        *[(F.col(f"__s{i}") / F.nullif(F.col(f"__n{i}"), F.lit(0))).alias(m) for i, m in enumerate(measures)],
    )
    rows = intervals.distinct()
    same = [rows[c] == named[f"__w{i}"] for i, c in enumerate(window)]
    return rows.join(named, same).select(*[rows[c] for c in intervals.columns], *[named[m] for m in measures])


#: A day: the default width of the blocks of ``interval_means``.
DAY = 86_400


def interval_means(
    intervals: DataFrame,
    points: DataFrame,
    *,
    start: str,
    end: str,
    at: str,
    on: Sequence[str] = (),
    measures: Sequence[str],
    block_seconds: float = DAY,
) -> DataFrame:
    """Mean of each measure over the points of every interval, without a row per pair.

    The same rows and values as ``interval_join`` grouped by the interval: intervals that hold no
    point are left out, NULL measures are skipped (a measure NULL in all points has mean NULL),
    NaN and infinities count as in ``avg``.  Means are doubles.

    Running sums instead of pairs.  Points of one moment of an entity are added up first.  Time is cut
    into blocks; each distinct interval sends two probes, one before the points at its start and
    one behind those at its end, into the blocks where they fall.  In a block, one window over
    points and probes in order gives the sums up to each probe; sums of whole blocks
    before it come from a window over the block totals (as many rows an entity as blocks in the time
    span).  An interval's sums are the difference of its two probes, so the work is
    ``points + 2 * intervals`` whatever the windows overlap, and an entity is spread over its blocks.
    Running sums start anew in every block and the totals add up as decimals, so no error grows
    with the length of an entity's history.

    The plan is lazy, but for one staged table of the distinct intervals' means.
    """
    on = list(on)
    clash = set(measures) & set(intervals.columns)
    if clash:
        raise ValueError(f"measures that are columns of the intervals: {sorted(clash)}")
    kind = _kind(intervals.schema[start].dataType, intervals.schema[end].dataType, points.schema[at].dataType)
    lo, unit = _ordinal(intervals.schema, start, kind)
    hi, _ = _ordinal(intervals.schema, end, kind)
    t, _ = _ordinal(points.schema, at, kind)
    width = max(1, int(round(block_seconds * unit)))
    keys = [f"__k{i}" for i in range(len(on))]
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)]

    valid = F.col(f"`{start}`") <= F.col(f"`{end}`")
    for c in on:
        valid = valid & F.col(f"`{c}`").isNotNull()
    iv = intervals.where(valid).withColumns({"__lo": F.expr(lo), "__hi": F.expr(hi)})
    block = F.floor(F.col("__t") / F.lit(width)).cast("long") if kind == "number" else F.expr(f"floor(__t / {width}L)")

    # per moment: the number of points, and of each measure count, finite sum and other values
    # (NaN and infinity count 1, NaN and -infinity 2^32, so one number holds both counts)
    ms = range(len(measures))
    pt = points.where(f"`{at}` IS NOT NULL").select(
        *named, F.expr(t).alias("__t"), *[F.col(f"`{m}`").cast("double").alias(f"__m{i}") for i, m in enumerate(measures)]
    )
    for k in keys:
        pt = pt.where(f"{k} IS NOT NULL")
    sums = {"__n": "count(1)"}
    for i in ms:
        sums[f"__c{i}"] = f"count(__m{i})"
        sums[f"__s{i}"] = f"coalesce(sum(CASE WHEN abs(__m{i}) < double('inf') THEN __m{i} END), 0D)"
        sums[f"__f{i}"] = (
            f"sum(CASE WHEN __m{i} >= double('inf') THEN 1L ELSE 0L END "
            f"+ CASE WHEN isnan(__m{i}) OR __m{i} = double('-inf') THEN 4294967296L ELSE 0L END)"
        )
    moments = pt.withColumn("__b", block).groupBy(*keys, "__b", "__t").agg(*[F.expr(v).alias(n) for n, v in sums.items()])

    probes = (
        iv.select(*named, "__lo", "__hi").distinct()
        .withColumn("__probe", F.explode(F.array(
            F.struct(F.col("__lo").alias("t"), F.lit(0).alias("place"), F.lit(-1).alias("sign")),
            F.struct(F.col("__hi").alias("t"), F.lit(2).alias("place"), F.lit(1).alias("sign")),
        )))
        .select(*keys, "__lo", "__hi", F.col("__probe.t").alias("__t"), F.col("__probe.place").alias("__place"), F.col("__probe.sign").alias("__sign"))
        .withColumn("__b", block)
    )
    rows = moments.withColumn("__place", F.lit(1)).unionByName(probes, allowMissingColumns=True)
    up_to = Window.partitionBy(*keys, "__b").orderBy("__t", "__place").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select(*keys, "__b", "__lo", "__hi", "__sign", *[F.coalesce(F.sum(n).over(up_to), F.lit(0)).alias(n) for n in sums])
    inside = inside.where("__sign IS NOT NULL")

    # sums of the blocks before a block; sums of values as exact numbers
    blocks = rows.groupBy(*keys, "__b").agg(
        *[(F.sum(n).try_cast("decimal(38,10)") if n.startswith("__s") else F.sum(n)).alias(n) for n in sums]
    )
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "__b", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in sums])

    found = inside.join(blocks, [*keys, "__b"])

    def difference(n):  # the sign is not a factor: a product would cut the decimals' scale
        return F.sum(F.when(F.col("__sign") > 0, F.col(n)).otherwise(-F.col(n)))

    signed = [
        (difference(n) + difference(f"{n}_before").cast("double" if n.startswith("__s") else "long")).alias(n) for n in sums
    ]
    found = found.groupBy(*keys, "__lo", "__hi").agg(*signed).where("__n > 0")

    def mean(i):
        return F.expr(
            f"CASE WHEN __c{i} = 0 THEN NULL WHEN __f{i} % 4294967296L > 0 AND __f{i} >= 4294967296L THEN double('NaN') "
            f"WHEN __f{i} > 0 AND __f{i} < 4294967296L THEN double('inf') WHEN __f{i} > 0 THEN double('-inf') "
            f"ELSE __s{i} / __c{i} END"
        )

    # a table of its own: the join back then reads two plain exchanges, which adaptive execution
    # can split where many intervals are the same
    means, _ = materialize(found.select(*keys, "__lo", "__hi", *[mean(i).alias(f"__m{i}") for i in ms]), "interval_means")
    cond = [iv[c] == means[k] for c, k in zip(on, keys, strict=True)] + [iv[c] == means[c] for c in ("__lo", "__hi")]
    return iv.join(means, cond).select(
        *[iv[c] for c in intervals.columns], *[means[f"__m{i}"].alias(m) for i, m in enumerate(measures)]
    )


def window_enrich_left(
    intervals: DataFrame,
    points: DataFrame,
    *,
    key: str,
    start: str,
    end: str,
    at: str,
    group_by: Sequence[str],
    measures: Sequence[str],
    bucket_seconds: float | Buckets | None = None,
    fanout: int = 64,
    salt: int = 1,
    lane_rows: int | None = LANE_ROWS,
    groups: str = "first",
) -> DataFrame:
    """Left enrichment of intervals with the means of the points inside them.

    Points of any entity inside ``[start, end]`` are grouped by ``group_by``; only the first
    group in ascending ``group_by`` order is attached (its keys and means), or with
    ``groups="all"`` every group, one row per interval and group.  Groups with a
    NULL key are ignored.  Intervals without a point keep their columns; the attached
    columns are NULL.  ``key`` must identify an interval.  A ``group_by`` column that the
    intervals also have is overwritten by the group's value when a group exists.

    Plan: a bucketed *inner* join (adaptive execution can split a hot bucket on either side,
    which it cannot do for the NULL-supplying side of an outer join), means per (interval,
    group), then one aggregate per interval over those candidates unioned with a plain
    projection of all intervals; the union keeps intervals without points, so nothing is
    joined back.  Time is the join's only equi key, so a moment that holds a large share of the points
    is one hot bucket: such buckets are split into lanes (``lane_rows``, None for none).  All groups
    come from an inner join of the staged means with the intervals, and an anti join for the rest.
    """
    if groups not in ("first", "all"):
        raise ValueError(f"unknown groups {groups}")
    renamed = {c: f"__pt_{c}" for c in points.columns if c in intervals.columns or c in ("__iv", "__cand")}
    pts = points.withColumnsRenamed(renamed)
    g = [renamed.get(c, c) for c in group_by]
    ms = [renamed.get(c, c) for c in measures]
    p_at = renamed.get(at, at)
    for c in g:
        pts = pts.filter(F.col(c).isNotNull())
    pts = pts.select(p_at, *g, *ms)

    slim = intervals.select(key, start, end)
    if bucket_seconds is None:
        bucket_seconds = derive_buckets(slim, pts, start=start, end=end, at=p_at, fanout=fanout)
    pairs = _bucketed(slim, pts, pts.columns, start, end, p_at, [], bucket_seconds, fanout, salt=salt, lane_rows=lane_rows)
    per_group = pairs.groupBy(key, *g).agg(*[F.avg(m).alias(m) for m in ms])
    if groups == "all":
        return _with_all_groups(intervals, per_group, key, renamed, list(group_by), list(measures))
    iv_type = intervals.select(F.struct(*[F.col(f"`{c}`") for c in intervals.columns]).alias("s")).schema["s"].dataType
    candidates = per_group.select(
        key,
        F.struct(*[F.col(c) for c in g], *[F.col(m) for m in ms]).alias("__cand"),
        F.lit(None).cast(iv_type).alias("__iv"),
    )
    rows = intervals.select(
        key,
        F.lit(None).cast(candidates.schema["__cand"].dataType).alias("__cand"),
        F.struct(*[F.col(f"`{c}`") for c in intervals.columns]).alias("__iv"),
    )
    # the first group in key order (min over the struct), and the interval's own row
    first = candidates.unionByName(rows).groupBy(key).agg(
        F.min("__cand").alias("__first"), F.any_value("__iv", ignoreNulls=True).alias("__iv")
    )
    out = []
    for c in intervals.columns:
        if c in group_by:
            out.append(F.coalesce(F.col(f"__first.{renamed.get(c, c)}"), F.col(f"__iv.{c}")).alias(c))
        elif c in measures:
            out.append(F.col(f"__first.{renamed.get(c, c)}").alias(c))
        else:
            out.append(F.col(f"__iv.{c}").alias(c))
    out += [
        F.col(f"__first.{renamed.get(c, c)}").alias(c)
        for c in list(group_by) + list(measures)
        if c not in intervals.columns
    ]
    return first.select(*out)


def _with_all_groups(intervals, per_group, key, renamed, group_by, measures):
    """Intervals times their groups; those without a group keep one row."""
    means, _ = materialize(per_group.withColumnRenamed(key, "__key"), "groups_of_intervals")
    new = [c for c in group_by + measures if c not in intervals.columns]
    kept = [c for c in intervals.columns if c not in group_by + measures]
    found = {c: means[renamed.get(c, c)] for c in group_by + measures}
    matched = intervals.join(means, intervals[key] == means["__key"]).select(
        *[(intervals[c] if c in kept else found[c]).alias(c) for c in intervals.columns], *[found[c].alias(c) for c in new]
    )
    nothing = intervals.join(means.select("__key").distinct(), F.col(f"`{key}`") == F.col("__key"), "left_anti").select(
        *[
            F.lit(None).cast(means.schema[renamed.get(c, c)].dataType).alias(c) if c in measures else F.col(f"`{c}`")
            for c in intervals.columns
        ],
        *[F.lit(None).cast(means.schema[renamed.get(c, c)].dataType).alias(c) for c in new],
    )
    return matched.unionByName(nothing)
