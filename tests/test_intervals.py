from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from convoy.operators import intervals as iv_module
from convoy.operators.intervals import Buckets, derive_buckets, interval_join, interval_means, window_enrich_left

T0 = datetime(2024, 1, 1)
ORDERS = "order_id string, vehicle_id string, ws timestamp_ntz, we timestamp_ntz"
SAMPLES = "vehicle_id string, ts timestamp_ntz, speed double"


def t(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def _pairs(df):
    return sorted((r["order_id"], r["ts"]) for r in df.select("order_id", "ts").collect())


def test_closed_bounds_nulls_and_overlaps(spark):
    orders = spark.createDataFrame(
        [
            ("o1", "v1", t(0), t(10)),  # samples exactly at both ends count
            ("o2", "v1", t(10), t(20)),  # shares the instant t(10) with o1
            ("o3", "v1", t(100), t(110)),  # no sample: vanishes
            ("o4", None, t(0), t(10)),  # NULL vehicle never matches
            ("o5", "v1", None, t(10)),  # NULL bound never matches
            ("o6", "v1", t(10), t(0)),  # start after end matches nothing
        ],
        ORDERS,
    )
    samples = spark.createDataFrame(
        [("v1", t(0), 1.0), ("v1", t(10), 2.0), ("v1", t(20), 3.0), ("v2", t(5), 4.0), (None, t(5), 5.0)],
        SAMPLES,
    )
    got = interval_join(orders, samples, start="ws", end="we", at="ts", on=["vehicle_id"], bucket_seconds=120)
    assert _pairs(got) == [("o1", t(0)), ("o1", t(10)), ("o2", t(10)), ("o2", t(20))]
    plain = interval_join(orders, samples, start="ws", end="we", at="ts", on=["vehicle_id"], method="plain")
    assert _pairs(plain) == _pairs(got)
    assert set(got.columns) == {"order_id", "vehicle_id", "ws", "we", "ts", "speed"}


def test_bucket_plan_has_no_cartesian(spark):
    orders = spark.createDataFrame([("o1", "v1", t(0), t(10))], ORDERS)
    samples = spark.createDataFrame([("v1", t(1), 1.0)], SAMPLES)
    plan = interval_join(orders, samples, start="ws", end="we", at="ts", on=["vehicle_id"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "__i_bkt" in plan


window = st.tuples(st.integers(0, 3), st.integers(0, 2000), st.integers(0, 3000))


@settings(max_examples=15, deadline=None)
@given(
    wins=st.lists(window, min_size=1, max_size=12),
    pts=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 5000)), min_size=1, max_size=40),
    bucket=st.sampled_from([1, 7, 60, 900, 100000]),
    fanout=st.sampled_from([2, 4, 64]),
    salt=st.sampled_from([1, 3]),
)
def test_bucket_join_equals_brute_force(spark, wins, pts, bucket, fanout, salt):
    orders = spark.createDataFrame(
        [(f"o{i}", f"v{v}", t(s), t(s + d)) for i, (v, s, d) in enumerate(wins)], ORDERS
    )
    samples = spark.createDataFrame([(f"v{v}", t(m), float(j)) for j, (v, m) in enumerate(pts)], SAMPLES)
    got = interval_join(
        orders, samples, start="ws", end="we", at="ts", on=["vehicle_id"], bucket_seconds=bucket * 60,
        fanout=fanout, salt=salt,
    )
    expect = sorted(
        (f"o{i}", t(m))
        for i, (v, s, d) in enumerate(wins)
        for (pv, m) in pts
        if pv == v and s <= m <= s + d
    )
    assert _pairs(got) == expect


def test_no_equi_key_uses_time_buckets_only(spark):
    orders = spark.createDataFrame([("o1", "x", t(0), t(30)), ("o2", "x", t(25), t(26))], ORDERS).drop("vehicle_id")
    samples = spark.createDataFrame([("a", t(1), 1.0), ("b", t(25.5), 2.0), ("c", t(40), 3.0)], SAMPLES)
    got = interval_join(orders, samples, start="ws", end="we", at="ts", bucket_seconds=60)
    assert _pairs(got) == [("o1", t(1)), ("o1", t(25.5)), ("o2", t(25.5))]


def test_window_enrich_left_first_group_only(spark):
    orders = spark.createDataFrame(
        [
            (1, 9, t(0), t(10)),
            (2, 9, t(23 * 60 + 50), t(24 * 60 + 10)),  # crosses midnight: first date only
            (3, 9, t(500), t(510)),  # nothing inside: kept, NULL means
        ],
        "seq long, vehicle_id long, ws timestamp_ntz, we timestamp_ntz",
    )
    samples = spark.createDataFrame(
        [
            (2, t(1), 10.0),
            (1, t(2), 20.0),  # vehicle 1 sorts first: its group wins
            (1, t(3), 40.0),
            (None, t(4), 99.0),  # NULL group key is ignored
            (1, t(23 * 60 + 55), 5.0),
            (1, t(24 * 60 + 5), 7.0),
        ],
        "vehicle_id long, ts timestamp_ntz, speed double",
    ).withColumn("event_date", F.to_date("ts"))
    got = window_enrich_left(
        orders, samples, key="seq", start="ws", end="we", at="ts",
        group_by=["vehicle_id", "event_date"], measures=["speed"], bucket_seconds=300,
    )
    rows = {r["seq"]: r for r in got.collect()}
    assert rows[1]["vehicle_id"] == 1 and rows[1]["speed"] == 30.0
    assert rows[2]["speed"] == 5.0 and str(rows[2]["event_date"]) == "2024-01-01"
    assert rows[3]["speed"] is None and rows[3]["vehicle_id"] == 9 and rows[3]["event_date"] is None
    assert got.count() == 3


@settings(max_examples=10, deadline=None)
@given(
    wins=st.lists(st.tuples(st.integers(0, 3000), st.integers(-5, 400)), min_size=1, max_size=10),
    pts=st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 3500), st.integers(0, 50)),
        min_size=0, max_size=30,
    ),
    bucket=st.sampled_from([30, 600, 7200]),
)
def test_window_enrich_left_equals_brute_force(spark, wins, pts, bucket):
    orders = spark.createDataFrame(
        [(i, 9, t(s), t(s + d)) for i, (s, d) in enumerate(wins)],
        "seq long, vehicle_id long, ws timestamp_ntz, we timestamp_ntz",
    )
    samples = spark.createDataFrame(
        [(v, t(m), float(x)) for v, m, x in pts], "vehicle_id long, ts timestamp_ntz, speed double"
    ).withColumn("event_date", F.to_date("ts"))
    got = window_enrich_left(
        orders, samples, key="seq", start="ws", end="we", at="ts",
        group_by=["vehicle_id", "event_date"], measures=["speed"], bucket_seconds=bucket,
    )
    got = {r["seq"]: (r["vehicle_id"], r["event_date"], r["speed"]) for r in got.collect()}
    assert len(got) == len(wins)
    for i, (s, d) in enumerate(wins):
        inside = [(v, t(m).date(), x) for v, m, x in pts if v is not None and s <= m <= s + d]
        if not inside:
            assert got[i] == (9, None, None)
            continue
        first = min((v, day) for v, day, _ in inside)
        xs = [x for v, day, x in inside if (v, day) == first]
        assert got[i][:2] == first and abs(got[i][2] - sum(xs) / len(xs)) < 1e-9


def test_hot_bucket_is_split_by_adaptive_skew_join(spark):
    """One vehicle-hour holds most samples: adaptive execution splits that join partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = spark.range(0, 30000).selectExpr(
            "'v0' AS vehicle_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.1) AS ts",
            "cast(id AS double) AS speed",
        )
        cold = spark.range(0, 3000).selectExpr(
            "concat('v', cast(1 + id % 7 AS string)) AS vehicle_id",
            "timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, cast(id AS int), 0) AS ts",
            "cast(id AS double) AS speed",
        )
        orders = spark.range(0, 40).selectExpr(
            "concat('o', cast(id AS string)) AS order_id",
            "concat('v', cast(id % 8 AS string)) AS vehicle_id",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS int), 0) AS ws",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS int) + 20, 0) AS we",
        )
        joined = interval_join(orders, hot.unionByName(cold), start="ws", end="we", at="ts", on=["vehicle_id"],
                               bucket_seconds=3600)
        got = len(joined.collect())  # executes this DataFrame's own (adaptive) plan
        # only v0 orders (ids 0, 8, 16, 24, 32) see the hot samples; cold samples are on day 2
        expect = sum(1 for i in range(0, 40, 8) for s in range(30000) if i * 60 <= s * 0.1 <= (i + 20) * 60)
        assert got == expect
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_enrichment_hot_time_bucket_is_split(spark):
    """The enrichment joins on the time bucket alone; a bucket holding most samples is split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        samples = spark.range(0, 20000).selectExpr(
            "id % 3 AS vehicle_id",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id % 3000) * 0.1) AS ts",
            "cast(id % 50 AS double) AS speed",
        ).withColumn("event_date", F.to_date("ts"))
        orders = spark.range(0, 60).selectExpr(
            "id AS seq", "cast(1 AS bigint) AS vehicle_id",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 5) AS ws",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 5 + 20) AS we",
        )
        got = window_enrich_left(
            orders, samples, key="seq", start="ws", end="we", at="ts",
            group_by=["vehicle_id", "event_date"], measures=["speed"], bucket_seconds=3600,
        )
        rows = got.collect()
        assert len(rows) == 60 and all(r["vehicle_id"] == 0 for r in rows)
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_bounds_of_every_kind_equal_the_plain_join(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        iv = spark.sql(
            "SELECT 1 AS k, DATE'2024-03-09' AS d0, DATE'2024-03-11' AS d1, TIMESTAMP_NTZ'2024-03-09 12:00:00' AS n0, "
            "TIMESTAMP_NTZ'2024-03-10 12:00:00' AS n1, TIMESTAMP'2024-03-09 12:00:00' AS z0, TIMESTAMP'2024-03-10 12:00:00' AS z1, "
            "1.25BD AS c0, 7.5BD AS c1, 3.0D AS f0, double('infinity') AS f1, 2 AS i0, 9 AS i1"
        )
        pts = spark.sql(
            "SELECT 1 AS k, DATE'2024-03-10' AS d, TIMESTAMP_NTZ'2024-03-10 03:00:00' AS n, "
            "TIMESTAMP'2024-03-10 04:00:00' AS z, 3.5BD AS c, 5e17D AS f, 4 AS i"
        )
        for lo, hi, at in (
            ("d0", "d1", "d"), ("d0", "d1", "n"), ("n0", "n1", "d"), ("n0", "n1", "n"), ("d0", "d1", "z"), ("z0", "z1", "d"),
            ("z0", "z1", "z"), ("c0", "c1", "c"), ("c0", "c1", "i"), ("i0", "i1", "c"), ("f0", "f1", "f"), ("f0", "f1", "i"), ("i0", "i1", "i"),
        ):
            for width in (0.5, 3600.0, 200_000.0):
                args = dict(start=lo, end=hi, at=at, on=["k"], bucket_seconds=width)
                got = interval_join(iv, pts.select("k", at), **args).count()
                assert got == interval_join(iv, pts.select("k", at), method="plain", **args).count() == 1, (lo, at, width)
        for lo, hi, at in (("n0", "n1", "z"), ("z0", "z1", "n"), ("i0", "i1", "d")):
            with pytest.raises(TypeError):
                interval_join(iv, pts.select("k", at), start=lo, end=hi, at=at, on=["k"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _means_of_pairs(orders, samples, measures, **kw):
    pairs = interval_join(orders, samples, method="plain", **kw)
    return pairs.groupBy(*orders.columns).agg(*[F.avg(m).alias(m) for m in measures])


def _same_means(got, want, measures):
    def rows(df):
        out = [F.round(F.col(m).cast("double"), 6).alias(m) for m in measures]
        keys = [c for c in df.columns if c not in measures]
        return sorted(map(repr, (tuple(r) for r in df.select(*sorted(keys), *out).distinct().collect())))

    assert rows(got) == rows(want)


@settings(max_examples=10, deadline=None)
@given(
    wins=st.lists(window, min_size=1, max_size=15),
    pts=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 5000), st.sampled_from([None, 0.1, -7.25, 1e9, float("nan"), float("inf"), float("-inf")])), min_size=1, max_size=60),
    block=st.sampled_from([60, 3600, 86_400]),
)
def test_means_from_running_sums_equal_means_of_pairs(spark, wins, pts, block):
    orders = spark.createDataFrame(
        [(f"o{i}", f"v{v}" if v else None, t(s), t(s + d)) for i, (v, s, d) in enumerate([*wins, *wins[:2]])], ORDERS
    )
    samples = spark.createDataFrame([(f"v{v}" if v else None, t(m), x) for v, m, x in pts], SAMPLES)
    kw = {"start": "ws", "end": "we", "at": "ts", "on": ["vehicle_id"]}
    got = interval_means(orders, samples, measures=["speed"], block_seconds=block, **kw)
    _same_means(got, _means_of_pairs(orders, samples, ["speed"], **kw), ["speed"])


@pytest.mark.parametrize("kind", ["date", "timestamp", "bigint", "double"])
def test_running_means_of_every_kind_of_bound(spark, kind):
    orders = spark.range(40).selectExpr("id AS o", "id % 3 AS k", "id * 7 % 50 AS s", "id * 7 % 50 + id % 9 AS e")
    samples = spark.range(300).selectExpr("id % 4 AS k", "id * 13 % 60 AS at", "id * 0.37 AS m", "cast(id % 5 AS int) AS n")

    def typed(c):
        if kind in ("bigint", "double"):
            return F.col(c).cast(kind)
        day = F.date_add(F.lit("1970-01-20").cast("date"), F.col(c).cast("int"))
        return day if kind == "date" else day.cast("timestamp")

    orders, samples = orders.withColumns({"s": typed("s"), "e": typed("e")}), samples.withColumn("at", typed("at"))
    kw = {"start": "s", "end": "e", "at": "at", "on": ["k"]}
    want = _means_of_pairs(orders, samples, ["m", "n"], **kw)
    _same_means(interval_means(orders, samples, measures=["m", "n"], **kw), want, ["m", "n"])


def test_running_means_of_a_hot_vehicle_and_moment(spark):
    """A third of the samples at one moment of one vehicle, a third more on that vehicle, and a
    third of the orders with one window: no task holds a vehicle, and no pair row is made."""
    samples = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('v', id % 50) END AS vehicle_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CASE WHEN id % 3 = 0 THEN 7000 ELSE id % 20000 END) AS ts",
        "cast(id % 97 AS double) / 7 AS speed",
    )
    orders = spark.range(3_000).selectExpr(
        "concat('o', id) AS order_id",
        "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('v', id % 50) END AS vehicle_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CASE WHEN id % 3 = 0 THEN 600 ELSE id % 15000 END) AS ws",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CASE WHEN id % 3 = 0 THEN 9000 ELSE id % 15000 + id % 900 END) AS we",
    )
    kw = {"start": "ws", "end": "we", "at": "ts", "on": ["vehicle_id"]}
    got = interval_means(orders, samples, measures=["speed"], **kw)
    _same_means(got, _means_of_pairs(orders, samples, ["speed"], **kw), ["speed"])
    assert got.count() == len(got.select("order_id").distinct().collect())


def _hot_moment(spark, points=20_000, orders=300):
    """Half of the samples at one moment, the rest over a day; all windows over that moment."""
    samples = spark.range(points).selectExpr(
        "id % 3 AS vehicle_id",
        "timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(0, 0, 0, IF(id % 2 = 0, 0, id * 4)) AS ts",
        "cast(id AS double) AS speed",
    ).withColumn("event_date", F.to_date("ts"))
    windows = spark.range(orders).selectExpr(
        "id AS seq", "cast(9 AS bigint) AS vehicle_id",
        "timestamp_ntz'2024-01-01 06:00:00' - make_dt_interval(0, 0, 0, id) AS ws",
        "timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(0, 0, 0, id * 100) AS we",
    )
    return windows, samples


def test_lanes_split_hot_moments_alone_and_keep_the_result(spark, monkeypatch):
    monkeypatch.setattr(iv_module, "HOT_BUCKETS", 1000)
    windows, samples = _hot_moment(spark)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        options = dict(key="seq", start="ws", end="we", at="ts", group_by=["vehicle_id", "event_date"], measures=["speed"])
        columns = ["seq", "vehicle_id", "event_date", "speed"]
        plain = window_enrich_left(windows, samples, **options, bucket_seconds=3600, lane_rows=None).select(columns)
        laned = window_enrich_left(windows, samples, **options, bucket_seconds=3600, lane_rows=500).select(columns)
        rounded = [sorted((*r[:3], round(r[3], 9)) for r in d.collect()) for d in (plain, laned)]
        assert rounded[0] == rounded[1] and len(rounded[0]) == 300

        sides = []
        kept = iv_module._laned
        monkeypatch.setattr(iv_module, "_laned", lambda *a: sides.append((a, kept(*a))) or sides[-1][1])
        window_enrich_left(windows, samples, **options, bucket_seconds=3600, lane_rows=500)
        (before_iv, before_pt, _, _), (iv, pt) = sides[0]
        # a task holds whole lanes: the fullest bucket had half of the points, its fullest lane far fewer
        assert before_pt.groupBy("__p_bkt").count().agg(F.max("count")).first()[0] >= 10_000
        fullest = pt.groupBy("__p_bkt", "__p_a", "__p_b").count().agg(F.max("count")).first()[0]
        assert fullest <= 700
        # every point once per column of its bucket, buckets that are not hot in one lane
        assert pt.where("__p_b = 0").count() == before_pt.count()
        cold = before_pt.groupBy("__p_bkt").count().where("count <= 400").select("__p_bkt")
        assert pt.join(cold, "__p_bkt").where("__p_a > 0 OR __p_b > 0").count() == 0
        assert iv.where("__i_a = 0").count() == before_iv.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_lanes_of_both_sides_and_map_columns(spark):
    windows, samples = _hot_moment(spark, points=2_000, orders=400)
    windows = windows.drop("vehicle_id").withColumn("tags", F.create_map(F.lit("a"), F.col("seq")))
    samples = samples.drop("event_date").withColumn("extra", F.create_map(F.lit("b"), F.col("speed")))
    counted = []
    for rows in (None, 50):
        got = interval_join(windows, samples, start="ws", end="we", at="ts", bucket_seconds=3600, lane_rows=rows)
        assert got.columns == [*windows.columns, *samples.columns]
        counted.append(sorted(map(tuple, got.groupBy("seq").agg(F.count("*"), F.sum("vehicle_id"), F.sum("speed")).collect())))
    assert counted[0] == counted[1] and sum(r[1] for r in counted[0]) > 400 * 1000


def test_lanes_without_rows(spark):
    windows, samples = _hot_moment(spark, points=20, orders=5)
    for w, p in ((windows.limit(0), samples), (windows, samples.limit(0))):
        got = interval_join(
            w.drop("vehicle_id"), p.drop("event_date"), start="ws", end="we", at="ts", bucket_seconds=60, lane_rows=1
        )
        assert got.count() == 0


def test_all_groups_of_a_window(spark):
    orders = spark.createDataFrame(
        [(1, 9, t(0), t(10)), (2, 9, t(23 * 60 + 50), t(24 * 60 + 10)), (3, 8, t(500), t(510)), (4, None, None, t(5))],
        "seq long, vehicle_id long, ws timestamp_ntz, we timestamp_ntz",
    )
    samples = spark.createDataFrame(
        [
            (2, t(1), 10.0), (1, t(2), 20.0), (1, t(3), 40.0), (None, t(4), 99.0),
            (1, t(23 * 60 + 55), 5.0), (1, t(24 * 60 + 5), 7.0), (5, t(24 * 60 + 6), None),
        ],
        "vehicle_id long, ts timestamp_ntz, speed double",
    ).withColumn("event_date", F.to_date("ts"))
    got = window_enrich_left(
        orders, samples, key="seq", start="ws", end="we", at="ts",
        group_by=["vehicle_id", "event_date"], measures=["speed"], bucket_seconds=300, groups="all",
    )
    assert got.columns == ["seq", "vehicle_id", "ws", "we", "event_date", "speed"]
    rows = {(r["seq"], r["vehicle_id"], str(r["event_date"]), r["speed"]) for r in got.collect()}
    assert rows == {
        (1, 1, "2024-01-01", 30.0), (1, 2, "2024-01-01", 10.0),
        (2, 1, "2024-01-01", 5.0), (2, 1, "2024-01-02", 7.0), (2, 5, "2024-01-02", None),
        (3, 8, "None", None), (4, None, "None", None),
    } and got.count() == 7
    with pytest.raises(ValueError):
        window_enrich_left(
            orders, samples, key="seq", start="ws", end="we", at="ts", group_by=["vehicle_id"], measures=["speed"], groups="some"
        )


def test_plain_join_is_chosen_by_cost(spark):
    def inputs(vehicles, points, orders, seconds):
        samples = spark.range(points).selectExpr(
            f"id % {vehicles} AS v", f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * {seconds} / {points}) AS ts"
        )
        windows = spark.range(orders).selectExpr(
            "id AS o", f"id % {vehicles} AS v",
            f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * {seconds} / {orders}) AS ws",
            f"timestamp_ntz'2024-01-01 00:00:10' + make_dt_interval(0, 0, 0, id * {seconds} / {orders}) AS we",
        )
        return windows, samples

    def bucketed(windows, samples, **options):
        got = interval_join(windows, samples, start="ws", end="we", at="ts", on=("v",), **options)
        return "__i_bkt" in got._jdf.queryExecution().optimizedPlan().toString(), got.count()

    few = inputs(100, 10_000, 1_000, 86_400)  # 100 samples a vehicle
    assert bucketed(*few)[0] is False
    assert bucketed(*few, method="bucket") == (True, bucketed(*few)[1])
    assert bucketed(*few, lane_rows=10)[0] is True  # lanes need buckets
    many = inputs(2, 200_000, 6_000, 86_400)  # 100,000 samples a vehicle: every window would test them all
    assert bucketed(*many)[0] is True
    width = derive_buckets(*few, start="ws", end="we", at="ts", on=("v",))
    assert isinstance(width, Buckets) and width.plain
    # time alone as key: never plain, it would be a cross join
    assert not derive_buckets(*few, start="ws", end="we", at="ts").plain


def _rows_joined(df):
    """Collect, and the largest number of rows a join or an explode made on the way."""
    rows, seen = df.collect(), []

    def visit(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(plan.plan())
        found = plan.metrics().get("numOutputRows")
        if ("Join" in name or name == "GenerateExec") and found.isDefined():
            seen.append(found.get().value())
        for i in range(plan.children().size()):
            visit(plan.children().apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return rows, max(seen)


@pytest.mark.parametrize("method,lane_rows", [("bucket", None), ("bucket", 4), ("plain", None)])
def test_order_means_make_no_row_per_pair(spark, method, lane_rows):
    from convoy.plans import deliveries as dl

    orders = spark.range(400).selectExpr(
        "cast(id AS string) AS order_id", "'delivered' AS order_status", "date'2024-01-01' AS order_date",
        "0F AS delivery_latitude", "0F AS delivery_longitude",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS int)) AS delivery_start_datetime",
        "timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, cast(id AS int)) AS delivery_end_datetime",
        "concat('v', id % 2) AS vehicle_id",
    )
    samples = spark.range(12000).selectExpr(
        "concat('v', id % 2) AS vehicle_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, 15 * cast(id AS int)) AS sample_ts",
        *[f"cast(id % {k} AS double) AS {c}" for k, c in zip((7, 11, 13, 17), dl.SENSORS, strict=True)],
    )
    rows, largest = _rows_joined(dl.enriched_orders(orders, samples, method=method, lane_rows=lane_rows))
    pairs = dl.telemetry_pairs(orders, samples, method="plain")
    want = {r["order_id"]: r for r in pairs.groupBy("order_id").agg(*[F.avg(c).alias(c) for c in dl.SENSORS]).collect()}
    assert len(rows) == len(want) == 400 and pairs.count() > 1_000_000
    for r in rows:
        assert [r[c] for c in dl.SENSORS] == pytest.approx([want[r["order_id"]][c] for c in dl.SENSORS])
    assert largest < 200_000


@pytest.mark.parametrize("kind", ["fraction", "time"])
def test_averages_equal_those_of_the_pairs(spark, kind):
    """Random intervals, some open, inverted, NULL, of one point, or alike; moments that repeat; NaN, infinite
    and huge values that stay in their intervals."""
    import random

    from convoy.operators.intervals import interval_averages

    rng = random.Random(5)
    top = 2000
    ivs, pts = [], []
    for i in range(300):
        a = rng.randrange(-50, top)
        b = rng.choice([a, a + rng.randrange(40), a + rng.randrange(top), 10**6, a - 5, None])
        ivs.append((i // 2 if i < 40 else i, rng.choice(["a", "b", "c", None]), a, b))
    for i in range(1500):
        v = rng.choice([rng.random(), float(i), None]) if i % 300 else rng.choice([float("nan"), float("inf"), float("-inf"), 1e30])
        pts.append((rng.choice(["a", "a", "b", None]), rng.choice([rng.randrange(top), rng.randrange(30), None]), v, float(i % 9)))
    to = {
        "fraction": "cast({0} / 7 AS double)",
        "time": "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, {0} / 7.0)",
    }[kind]
    iv = spark.createDataFrame(ivs, "i int, v string, a long, b long").selectExpr("i", "v", f"{to.format('a')} AS ws", f"{to.format('b')} AS we")
    pt = spark.createDataFrame(pts, "v string, t long, m double, k double").selectExpr("v", f"{to.format('t')} AS ts", "m", "k")
    at = {"start": "ws", "end": "we", "at": "ts", "on": ("v",)}
    show = lambda df: sorted(
        str(tuple(f"{x:.9g}" if isinstance(x, float) else x for x in r)) for r in df.select("i", "v", "ws", "we", "m", "k").collect()
    )
    want = show(interval_join(iv, pt, method="plain", **at).groupBy("i", "v", "ws", "we").agg(F.avg("m").alias("m"), F.avg("k").alias("k")))
    assert len(want) > 50
    for how in ({"method": "bucket"}, {"method": "plain"}, {"method": "bucket", "lane_rows": 3}, {"method": "bucket", "salt": 3},
                {"bucket_seconds": 3.0}, {}):
        assert show(interval_averages(iv, pt, measures=("m", "k"), **how, **at)) == want, how
    empty = interval_averages(iv, pt.where("false"), measures=("m", "k"), method="bucket", **at)
    assert empty.columns == ["i", "v", "ws", "we", "m", "k"] and empty.count() == 0
