from hypothesis import given, settings
from hypothesis import strategies as st

from convoy.operators.sequence import accumulate, number_rows, running_sum, surrogate_key


@settings(max_examples=10, deadline=None)
@given(
    keys=st.lists(st.integers(-1000, 5000), min_size=1, max_size=60, unique=True),
    block=st.sampled_from([1, 3, 16, 1 << 20]),
    data=st.data(),
)
def test_blocked_running_sum_equals_global(spark, keys, block, data):
    vals = [data.draw(st.one_of(st.none(), st.integers(0, 100))) for _ in keys]
    df = spark.createDataFrame(list(zip(keys, vals)), "k long, v long")
    got = {r["k"]: (r["s"], r["n"]) for r in accumulate(df, "k", sums={"s": "v"}, row_number="n", block=block).collect()}
    run = 0
    for n, (k, v) in enumerate(sorted(zip(keys, vals)), start=1):
        run += v or 0
        assert got[k] == ((run if v is not None else None), n)


def test_wrappers_and_plan(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k").selectExpr("k", "k % 7 AS v")
    rs = running_sum(df, "v", "k", "s", block=512)
    assert rs.agg({"s": "max"}).first()[0] == sum(k % 7 for k in range(5000))
    sk = surrogate_key(df, "k", "rid", block=512)
    assert sorted(r["rid"] for r in sk.collect()) == list(range(1, 5001))
    plan = rs._jdf.queryExecution().executedPlan().toString()
    # the row-level window is partitioned by block; only the block totals go to one partition
    assert "hashpartitioning(__blk" in plan


def test_tiebreak_and_key_type(spark):
    import pytest

    df = spark.createDataFrame([(1, "b", 5), (1, "a", 7), (0, "z", 1)], "k long, t string, v long")
    got = sorted(tuple(r) for r in accumulate(df, "k", sums={"s": "v"}, row_number="n", block=1, tiebreak=("t",)).collect())
    assert got == [(0, "z", 1, 1, 1), (1, "a", 7, 8, 2), (1, "b", 5, 13, 3)]
    with pytest.raises(TypeError):
        accumulate(df, "t", row_number="n")


@settings(max_examples=8, deadline=None)
@given(
    rows=st.lists(st.tuples(st.sampled_from([None, "a", "b", "hot"]), st.integers(-300, 3000)), min_size=1, max_size=60, unique_by=lambda r: r[1]),
    block=st.sampled_from([1, 7, 1 << 20]),
    data=st.data(),
)
def test_running_sums_and_numbers_per_group(spark, rows, block, data):
    rows = [(g, k, data.draw(st.one_of(st.none(), st.integers(0, 100)))) for g, k in rows]
    df = spark.createDataFrame(rows, "`a b` string, k long, v long")
    got = accumulate(df, "k", sums={"s": "v"}, row_number="n", block=block, partition_by=("a b",)).collect()
    assert len(got) == len(rows)
    got = {r["k"]: (r["s"], r["n"]) for r in got}
    for g in {r[0] for r in rows}:
        run = 0
        for n, (_, k, v) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1]), start=1):
            run += v or 0
            assert got[k] == ((run if v is not None else None), n)


def test_a_group_spans_many_blocks(spark):
    """One group holds all rows: no window holds more than a block of them."""
    df = spark.range(4000).selectExpr("id AS k", "if(id >= 0, 'hot', 'x') AS g", "1L AS v")
    out = accumulate(df, "k", sums={"s": "v"}, block=100, partition_by=("g",))
    assert out.where("s <> k + 1").count() == 0
    assert "hashpartitioning(g" in (plan := out._jdf.queryExecution().executedPlan().toString()) and "__blk0" in plan


def test_rows_numbered_by_any_columns(spark):
    rows = [(None if i % 11 == 0 else f"t{i % 3}", None if i % 7 == 0 else i % 5, i) for i in range(500)]
    rows += [("t1", 1, i) for i in range(1000, 1500)]  # half of the rows share two columns
    df = spark.createDataFrame(rows, "`a.b` string, m int, k int")
    want = sorted(rows, key=lambda r: ((r[0] is not None, r[0]), (r[1] is not None, r[1]), r[2]))
    for partitions in (1, 7, 16):
        got = number_rows(df, ("a.b", "m", "k"), "n", partitions).orderBy("n").collect()
        assert [tuple(r)[:3] for r in got] == want
        assert [r["n"] for r in got] == list(range(1, 1001))
    assert number_rows(df.limit(0), ("a.b",), "n").count() == 0


def test_strict_chain_and_status_question(spark):
    import pytest

    from convoy.plans import fleet as fl

    df = spark.createDataFrame([(1, 5, "in transit"), (2, None, None), (3, 7, "pending")], "seq long, delivery_time long, delivery_status string")
    ends = {r["seq"]: r["delivery_end_epoch"] for r in fl.chained_windows(df).collect()}
    assert ends == {1: 1704085205, 2: None, 3: 1704085212}
    with pytest.raises(Exception, match="no duration for order 2"):
        fl.chained_windows(df, strict=True).collect()
    assert [r["seq"] for r in fl.orders_with_status(df).collect()] == [1]  # an unknown status is not in transit
