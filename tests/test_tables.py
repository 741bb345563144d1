import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from convoy.operators.tables import TableSpec, dedupe_latest, read_table, write_layouts, write_table

SCHEMA = "order_id string, order_date date, order_status string, vehicle_id string, speed double"
SPEC = TableSpec("orders", "order_id", "order_date", ("order_date", "order_status"))
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def rows(df):
    return sorted(tuple(r) for r in df.select("order_id", "order_date", "order_status", "vehicle_id", "speed").collect())


def test_dedupe_latest_is_deterministic(spark):
    df = spark.createDataFrame(
        [
            ("o1", D1, "pending", None, None),
            ("o1", D2, "delivered", "V1", 10.0),  # later ordering value wins
            ("o2", D2, "delivered", "V1", 1.0),
            ("o2", D2, "delivered", "V2", 1.0),  # tie on ordering: larger remaining columns win
            ("o3", None, "pending", None, None),
            ("o3", D1, "pending", None, None),  # NULL ordering loses
        ],
        SCHEMA,
    )
    got = rows(dedupe_latest(df, "order_id", "order_date"))
    assert got == [("o1", D2, "delivered", "V1", 10.0), ("o2", D2, "delivered", "V2", 1.0), ("o3", D1, "pending", None, None)]
    again = rows(dedupe_latest(df.orderBy(F.rand(7)), "order_id", "order_date"))
    assert again == got


def test_replace_partitions_and_null_partition_values(spark, tmp_dir):
    df = spark.createDataFrame(
        [("o1", D1, "pending", None, None), ("o2", D1, "in transit", "V1", 55.0), ("o3", D2, None, "V2", 20.0)], SCHEMA
    )
    path = write_table(df, SPEC, os.path.join(tmp_dir, "t"))
    back = read_table(spark, path)
    assert back.columns == df.columns and back.schema == df.schema
    assert rows(back) == rows(df)
    assert os.path.isdir(os.path.join(path, "order_date=2024-01-02", "order_status=__HIVE_DEFAULT_PARTITION__"))


def test_upsert_moves_keys_and_is_idempotent(spark, tmp_dir):
    base = spark.createDataFrame(
        [("o1", D1, "in transit", "V1", 10.0), ("o2", D1, "pending", None, None), ("o3", D1, "delivered", "V2", 3.0)],
        SCHEMA,
    )
    path = write_table(base, SPEC, os.path.join(tmp_dir, "t"))
    batch = spark.createDataFrame(
        [("o1", D2, "delivered", "V1", 12.0), ("o4", D3, "pending", None, None), ("o3", D1, "delivered", "V9", 1.0)],
        SCHEMA,
    )
    write_table(batch, SPEC, path, "upsert")
    once = rows(read_table(spark, path))
    write_table(batch, SPEC, path, "upsert")
    assert rows(read_table(spark, path)) == once
    assert once == [
        ("o1", D2, "delivered", "V1", 12.0),  # moved out of (D1, in transit)
        ("o2", D1, "pending", None, None),  # untouched
        ("o3", D1, "delivered", "V9", 1.0),  # same ordering value: tie broken by columns
        ("o4", D3, "pending", None, None),  # new
    ]
    # the partition the key moved out of became empty and is gone
    assert not os.path.exists(os.path.join(path, "order_date=2024-01-01", "order_status=in transit"))


def test_upsert_order_independent(spark, tmp_dir):
    a = spark.createDataFrame([("o1", D1, "pending", None, None)], SCHEMA)
    b = spark.createDataFrame([("o1", D2, "delivered", "V1", 5.0)], SCHEMA)
    p1 = write_table(a, SPEC, os.path.join(tmp_dir, "x"))
    write_table(b, SPEC, p1, "upsert")
    p2 = write_table(b, SPEC, os.path.join(tmp_dir, "y"))
    write_table(a, SPEC, p2, "upsert")
    assert rows(read_table(spark, p1)) == rows(read_table(spark, p2)) == [("o1", D2, "delivered", "V1", 5.0)]


def test_partition_scope_keeps_one_row_per_partition(spark, tmp_dir):
    spec = TableSpec("daily", "order_date", "order_date", ("order_status",), scope="partition")
    df = spark.createDataFrame([("a", D1, "pending", None, 1.0), ("b", D1, "delivered", None, 2.0)], SCHEMA)
    path = write_table(df, spec, os.path.join(tmp_dir, "t"))
    assert read_table(spark, path).count() == 2


def test_single_column_key_loses_rows(spark, tmp_dir):
    """A record key of order_date alone (as the compliance table declares) keeps one vehicle
    per date; the (order_date, vehicle_id) key keeps them all."""
    df = spark.createDataFrame(
        [("x", D1, "d", "V1", 1.0), ("y", D1, "d", "V2", 2.0), ("z", D2, "d", "V1", 3.0)], SCHEMA
    )
    narrow = TableSpec("compliance_check", "order_date", "order_date", ("order_date",))
    wide = TableSpec("compliance_check", ("order_date", "vehicle_id"), "order_date", ("order_date",))
    assert read_table(spark, write_table(df, narrow, os.path.join(tmp_dir, "n"))).count() == 2
    assert read_table(spark, write_table(df, wide, os.path.join(tmp_dir, "w"))).count() == 3


def test_pruned_read_plan(spark, tmp_dir):
    df = spark.createDataFrame(
        [("o1", D1, "delivered", "V1", 60.0), ("o2", D2, "delivered", "V1", 70.0), ("o3", D2, "pending", None, None)],
        SCHEMA,
    )
    path = write_table(df, SPEC, os.path.join(tmp_dir, "t"))
    q = read_table(spark, path).filter((F.col("order_date") == D2) & (F.col("speed") > 50))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan and "PushedFilters: [IsNotNull(speed), GreaterThan(speed,50.0)]" in plan
    assert rows(q) == [("o2", D2, "delivered", "V1", 70.0)]


def test_write_layouts(spark, tmp_dir):
    df = spark.createDataFrame([("o1", D1, "delivered", "V1", 60.0), ("o2", D2, "pending", None, None)], SCHEMA)
    specs = {
        "by_vehicle": SPEC.with_partitions(("vehicle_id", "order_status", "order_date")),
        "by_status": SPEC.with_partitions(("order_status", "order_date", "vehicle_id")),
        "by_date": SPEC.with_partitions(("order_date", "order_status", "vehicle_id")),
    }
    paths = write_layouts(df, specs, tmp_dir)
    for p in paths.values():
        assert rows(read_table(spark, p)) == rows(df)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_row = st.tuples(
    st.sampled_from(["o1", "o2", "o3", "o4"]),
    st.sampled_from([D1, D2, D3]),
    st.sampled_from(["pending", "in transit", "delivered"]),
    st.sampled_from([None, "V1", "V2"]),
    st.sampled_from([None, 1.0, 2.0]),
)


@settings(max_examples=6, deadline=None)
@given(batches=st.lists(st.lists(_row, min_size=1, max_size=5), min_size=1, max_size=3))
def test_sequential_upserts_equal_latest_over_all_batches(spark, batches):
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="convoy-prop-"), "t")
    for b in batches:
        write_table(spark.createDataFrame(b, SCHEMA), SPEC, path, "upsert")
    everything = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    assert rows(read_table(spark, path)) == rows(dedupe_latest(everything, "order_id", "order_date"))


def test_dedupe_hot_key_is_combined_map_side(spark):
    """A key holding a third of the rows is reduced per task before the shuffle."""
    df = spark.range(0, 3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', cast(id AS string)) END AS order_id",
        "date_add(date'2024-01-01', cast(id % 10 AS int)) AS order_date",
        "'delivered' AS order_status", "cast(NULL AS string) AS vehicle_id", "cast(id AS double) AS speed",
    )
    d = dedupe_latest(df, "order_id", "order_date")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # map-side combine before the exchange on the key
    hot = d.filter("order_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0]["order_date"] == date(2024, 1, 10) and hot[0]["speed"] == 2979.0


def _kv(spark, rows, schema="k long, p boolean, v long"):
    return spark.createDataFrame(rows, schema)


def test_unpartitioned_upserts_keep_the_table(spark, tmp_dir):
    spec, path = TableSpec("t", "k", "v"), f"{tmp_dir}/t"
    write_table(_kv(spark, [(i, True, 0) for i in range(100)]), spec, path)
    for n in (1, 2):
        write_table(_kv(spark, [(n, False, n)]), spec, path, "upsert")
        assert read_table(spark, path).count() == 100
    assert sorted(r["v"] for r in read_table(spark, path).where("not p").collect()) == [1, 2]


def test_moved_keys_leave_boolean_and_timestamp_partitions(spark, tmp_dir):
    import datetime as dt

    for kind, a, b in (
        ("boolean", True, False),
        ("timestamp_ntz", dt.datetime(2024, 1, 1, 0, 0, 0, 500_000), dt.datetime(2024, 1, 2)),
        ("string", "a b/c:%", None),
    ):
        spec, path = TableSpec("t", "k", "v", "p"), f"{tmp_dir}/{kind}"
        schema = f"k long, p {kind}, v long"
        write_table(_kv(spark, [(1, a, 1)], schema), spec, path)
        write_table(_kv(spark, [(1, b, 2), (2, b, 2)], schema), spec, path, "upsert")
        assert sorted((r["k"], r["p"], r["v"]) for r in read_table(spark, path).collect()) == [(1, b, 2), (2, b, 2)]


def test_upsert_refuses_another_spec_and_unknown_files(spark, tmp_dir):
    rows = _kv(spark, [(1, True, 1), (2, False, 2)])
    write_table(rows, TableSpec("t", "k", "v"), f"{tmp_dir}/t")
    with pytest.raises(ValueError, match="keys"):
        write_table(rows, TableSpec("t", "v", "v"), f"{tmp_dir}/t", "upsert")
    rows.write.parquet(f"{tmp_dir}/files")
    with pytest.raises(ValueError, match="no table description"):
        write_table(rows, TableSpec("t", "k", "v"), f"{tmp_dir}/files", "upsert")


def test_upsert_scans_touched_partitions_only(spark, tmp_dir):
    """The scan is pruned at run time by the partitions the batch names, whatever their type."""
    from convoy.operators.tables import rows_of_partitions

    spec = TableSpec("t", "k", "v", "p")
    path = write_table(_kv(spark, [(i, i % 2 == 0, i) for i in range(10)]), spec, f"{tmp_dir}/t")
    touched = f"{tmp_dir}/touched"
    _kv(spark, [(1, True, 1)]).groupBy("p").agg(F.count("*").alias("__rows")).write.parquet(touched)
    old = rows_of_partitions(read_table(spark, path), spark.read.parquet(touched), ["p"])
    assert sorted(r["k"] for r in old.collect()) == [0, 2, 4, 6, 8]
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(p" in plan and "PartitionFilters: [isnull(p" in plan


PARTITION_TYPES = {
    "timestamp_ntz": ["2024-03-10 02:30:00", "2024-11-03 01:30:00.25", "2024-01-01 00:00:00"],
    "timestamp": ["2024-11-03 01:30:00", "2024-03-10 03:30:00.25", "2024-01-01 00:00:00"],
    "date": ["2024-03-10", "1969-12-31", "2024-01-01"],
    "decimal(10,2)": ["1.50", "-0.25", "100.00"],
    "boolean": ["true", "false", "false"],
    "double": ["0.1", "NaN", "-3.0"],
    "string": ["a b/c", "", "%3A"],
    "bigint": ["1", "-1", "9007199254740993"],
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", PARTITION_TYPES)
def test_upsert_keeps_every_row_of_a_touched_partition(spark, tmp_dir, kind, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        one, two, three = PARTITION_TYPES[kind]
        table = [("a", one, 0), ("b", one, 0), ("c", one, 0), ("d", two, 0), ("e", two, 0), ("f", three, 0), ("g", None, 0), ("h", None, 0)]

        def frame(rows):
            return spark.createDataFrame(rows, "k string, p string, v int").select("k", F.col("p").cast(kind).alias("p"), "v")

        spec = TableSpec("t", "k", "v", "p")
        path = write_table(frame(table), spec, f"{tmp_dir}/t")
        # a row new, a row changed in place, a row moved to another and one to the NULL partition
        batch = [("z", one, 1), ("b", one, 1), ("d", one, 1), ("f", None, 1)]
        write_table(frame(batch), spec, path, "upsert")
        want = {k: (p, v) for k, p, v in [*table, *batch]}
        got = {r["k"]: (r["p"], r["v"]) for r in read_table(spark, path).select("k", F.col("p").cast("string").alias("p"), "v").collect()}
        stored = {r["k"]: (r["p"], r["v"]) for r in frame([(k, *x) for k, x in want.items()]).select("k", F.col("p").cast("string").alias("p"), "v").collect()}
        if kind == "string":  # the empty text as a partition value is NULL in a Hive-style folder
            stored = {k: (p or None, v) for k, (p, v) in stored.items()}
        assert got == stored
        assert read_table(spark, path).count() == len(want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_upsert_finds_old_homes_of_typed_and_null_keys(spark, tmp_dir, zone):
    """Keys that are zone-free moments or NULL leave the partition they move out of."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        def frame(rows):
            return spark.createDataFrame(rows, "k string, p string, v int").select(F.col("k").cast("timestamp_ntz").alias("k"), "p", "v")

        spec = TableSpec("t", "k", "v", "p")
        path = write_table(frame([("2024-03-10 02:30:00", "a", 0), (None, "a", 0), ("2024-05-01", "a", 0)]), spec, f"{tmp_dir}/t")
        write_table(frame([("2024-03-10 02:30:00", "b", 1), (None, "b", 1)]), spec, path, "upsert")
        got = sorted((str(r["k"]), r["p"], r["v"]) for r in read_table(spark, path).collect())
        assert got == [("2024-03-10 02:30:00", "b", 1), ("2024-05-01 00:00:00", "a", 0), ("None", "b", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("partition", [(), ("p",)])
@pytest.mark.parametrize("mode", ["replace", "upsert"])
def test_a_write_that_fails_midway_leaves_the_old_table(spark, tmp_dir, mode, partition):
    spec = TableSpec("t", "k", "v", partition)
    old = _kv(spark, [(i, i % 2 == 0, i) for i in range(20)])
    path = write_table(old, spec, f"{tmp_dir}/t")
    bad = _kv(spark, [(i, True, 99) for i in range(40)]).withColumn(
        "v", F.when(F.col("k") == 37, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        write_table(bad, spec, path, mode)
    assert sorted(map(tuple, read_table(spark, path).collect())) == sorted(map(tuple, old.collect()))
    write_table(_kv(spark, [(1, False, 7)]), spec, path, "upsert")  # and it can be written again
    assert {r["k"]: r["v"] for r in read_table(spark, path).collect()}[1] == 7


def test_a_write_that_stops_between_the_renames_is_completed(spark, tmp_dir, monkeypatch):
    from convoy.operators import tables

    spec = TableSpec("t", "k", "v")
    path = write_table(_kv(spark, [(1, True, 1)]), spec, f"{tmp_dir}/t")
    real = tables._move

    def stops(spark, source, target):
        if target == path:
            raise OSError("killed")
        real(spark, source, target)

    monkeypatch.setattr(tables, "_move", stops)
    with pytest.raises(OSError, match="killed"):
        write_table(_kv(spark, [(1, True, 2)]), spec, path)
    monkeypatch.setattr(tables, "_move", real)
    assert not os.path.exists(path)
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(1, True, 2)]


def test_upsert_refuses_other_columns(spark, tmp_dir):
    spec = TableSpec("t", "k", "v")
    path = write_table(_kv(spark, [(1, True, 1)]), spec, f"{tmp_dir}/t")
    with pytest.raises(ValueError, match="columns"):
        write_table(_kv(spark, [(1, True, 2)]).withColumn("more", F.lit(1)), spec, path, "upsert")


def test_a_repeated_key_fails_a_write_of_unique_rows(spark, tmp_dir):
    """The old table stays, NULL keys count, and nothing is left beside it."""
    spec = TableSpec("t", ("k", "p"), "v", ("p",))
    path = os.path.join(tmp_dir, "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, p int, v int")
    write_table(rows(("a", 1, 1), ("a", 2, 2), (None, 1, 3)), spec, path, assume_unique=True)
    for again in [(("a", 1, 1), ("a", 1, 2)), ((None, 1, 3), (None, 1, 4))]:
        with pytest.raises(ValueError, match="not unique by k, p"):
            write_table(rows(*again), spec, path, assume_unique=True)
        assert sorted(os.listdir(tmp_dir)) == ["t"]
        assert read_table(spark, path).count() == 3
    write_table(rows(("a", 1, 1), ("a", 1, 2)), spec, path)  # without the promise the latest row wins
    assert [r["v"] for r in read_table(spark, path).collect()] == [2]


def test_hot_partition_is_split_by_rows_however_small_its_bytes(spark, tmp_dir):
    """Rows that compress to almost nothing: a partition value with nearly all of them is several
    tasks' work and several files, each a range of keys."""
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    old = spark.conf.get(key)
    spec = TableSpec("t", "k", "v", "p")
    rows = spark.range(200_000).selectExpr("id AS k", "0 AS v", "CASE WHEN id < 10 THEN 'b' ELSE 'a' END AS p")
    try:
        spark.conf.set(key, "10k")
        path = write_table(rows, spec, f"{tmp_dir}/t")
        write_table(rows.where("k % 2 = 0").selectExpr("k", "1 AS v", "p"), spec, path, "upsert")
    finally:
        spark.conf.set(key, old)
    got = read_table(spark, path)
    assert got.count() == 200_000 and got.where("v = (1 - k % 2)").count() == 200_000
    files = spark.read.parquet(path).where("p = 'a'").groupBy("_metadata.file_name").agg(
        F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")
    ).orderBy("low").collect()
    assert len(files) >= 3 and max(f["n"] for f in files) < 100_000
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:]))
