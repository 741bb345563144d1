import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from convoy.operators.normalise import normalise_orders, normalise_telemetry
from convoy.operators.typed import typed_with_rejects
from convoy.sources import files
from convoy.sources.arrays import scan_json_array


def test_json_array_file_and_normalise(spark, tmp_dir):
    p = os.path.join(tmp_dir, "iot.json")
    with open(p, "w") as f:
        f.write(
            '[{"latitude": 1.5, "longitude": -2.0, "speed": 55, "battery_temperature": 31, "timestamp": 1704085200,'
            ' "tire_pressure": 32, "maintenance_required": true, "last_service_date": "1/5/2024"},'
            ' {"speed": 10, "timestamp": "1704085205"}]'
        )
    raw = files.scan_json(spark, p, multiline=True)
    assert raw.count() == 2
    n = normalise_telemetry(raw, service_fields=True).orderBy("timestamp").collect()
    assert n[0]["location"] == "1.5,-2.0" and n[0]["timestamp"] == datetime(2024, 1, 1, 5, 0, 0)
    assert str(n[0]["last_service_date"]) == "2024-01-05" and n[0]["vehicle_id"] == 1
    assert n[1]["location"] is None and n[1]["battery_temperature"] is None
    assert n[1]["timestamp"] == datetime(2024, 1, 1, 5, 0, 5)


def test_csv_all_text_typed_and_empties(spark, tmp_dir):
    p = os.path.join(tmp_dir, "orders.csv")
    with open(p, "w") as f:
        f.write(
            "delivery_address,delivery_status,delivery_time,delivery_cost,recipient_name,order_date\n"
            "1 Main St,pending,120,9.5,Ann,1/5/2024\n"
            ",in transit,,3.0,,12/31/2024\n"
        )
    raw = files.scan_csv(spark, p)
    assert all(t == "string" for _, t in raw.dtypes)
    assert raw.collect()[1]["delivery_address"] is None
    typed = files.scan_csv_typed(
        spark, p, "delivery_address string, delivery_status string, delivery_time long, delivery_cost double, "
        "recipient_name string, order_date string",
    )
    n = normalise_orders(typed).collect()
    assert str(n[0]["order_date"]) == "2024-01-05" and n[1]["delivery_time"] is None


def test_parquet_ms_round_trip_and_sql(spark, tmp_dir):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 123456), "a")], "t timestamp_ntz, s string")
    p = files.sink_parquet_ms(df, os.path.join(tmp_dir, "p"))
    back = files.scan(spark, p, "parquet")
    assert back.first()["t"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    got = files.run_sql(spark, 'select count(*) AS n from {t} where s = "a"', t=back).first()["n"]
    assert got == 1
    files.register_view(back, "ms_view")
    assert spark.sql("select * from ms_view").count() == 1
    out = files.sink_csv(back, os.path.join(tmp_dir, "c"))
    assert files.scan_csv(spark, out).count() == 1


def _array_record(rnd, i):
    text = "".join(rnd.choice('ab{}[]",\\:\n é') for _ in range(rnd.randint(0, 20)))
    return {"i": i, "s": text, "n": {"x": {"y": [{"z": text[::-1]} for _ in range(rnd.randint(0, 2))]}}}


ARRAY_SCHEMA = "i long, s string, n struct<x: struct<y: array<struct<z: string>>>>"


def test_json_arrays_are_split_and_joined_again(spark, tmp_dir):
    """Braces, quotes, escapes and line ends inside strings, nested records, records and strings over
    several splits: the rows of the reader that takes a file whole."""
    rnd = random.Random(5)
    for f, indent in enumerate([None, 2]):
        with open(os.path.join(tmp_dir, f"f{f}.json"), "w") as out:
            json.dump([_array_record(rnd, 100 * f + i) for i in range(60)], out, indent=indent, ensure_ascii=bool(f))
    for name, text in {"none": "[]", "zero": "", "blank": " \n"}.items():
        with open(os.path.join(tmp_dir, f"{name}.json"), "w") as out:
            out.write(text)
    want = sorted(map(str, files.scan_json(spark, tmp_dir, ARRAY_SCHEMA, multiline=True).where("i IS NOT NULL").collect()))
    assert len(want) == 120
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        for size in (500, 10_000_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = scan_json_array(spark, tmp_dir, ARRAY_SCHEMA)
            assert sorted(map(str, got.collect())) == want
        spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
        one = os.path.join(tmp_dir, "f0.json")
        n_tasks = lambda df: df.select(F.spark_partition_id()).distinct().count()
        assert n_tasks(files.scan_json(spark, one, ARRAY_SCHEMA, multiline=True)) == 1
        assert n_tasks(spark.read.option("lineSep", "}").text(one)) > 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_unclosed_array_record_is_left_out(spark, tmp_dir):
    p = os.path.join(tmp_dir, "cut.json")
    with open(p, "w") as f:
        f.write('[{"i": 1, "s": "a}"}, {"i": 2, "s": "b", "n": {"x"')
    assert [r["i"] for r in scan_json_array(spark, p, ARRAY_SCHEMA).collect()] == [1]


def test_lines_with_wrong_number_of_fields_are_rejects(spark, tmp_dir):
    p = os.path.join(tmp_dir, "orders.csv")
    with open(p, "w") as f:
        f.write('id,day,note\na,2024-01-02 00:00:00,"x,y"\nb,2024-01-03 00:00:00\nc,2024-01-04 00:00:00,n,more\nd,soon,n\ne,,n\n')
    scanned = files.scan_csv(spark, p, malformed="line")
    for stage in (None, "lines"):
        typed, rejects = typed_with_rejects(scanned, {"day": ("date", None)}, malformed="line", stage=stage)
        assert typed.columns == ["id", "day", "note"]
        assert [(r["id"], str(r["day"]), r["note"]) for r in typed.orderBy("id").collect()] == [
            ("a", "2024-01-02", "x,y"), ("b", "2024-01-03", None), ("c", "2024-01-04", "n"), ("d", "None", "n"), ("e", "None", "n"),
        ]
        assert [(r["id"], r["line"], r["rejected_columns"]) for r in rejects.orderBy("id").collect()] == [
            ("b", "b,2024-01-03 00:00:00", []), ("c", "c,2024-01-04 00:00:00,n,more", []), ("d", None, ["day"]),
        ]
    assert rejects.select("line").where("line IS NOT NULL").count() == 2  # staged: the line alone can be read
    with pytest.raises(Exception, match="wrong number of fields|cannot convert"):
        typed_with_rejects(scanned.where("id <> 'd'"), {"day": ("date", None)}, mode="strict", malformed="line")[0].collect()


def test_malformed_lines_keep_their_header_when_files_are_split(spark, tmp_dir):
    from convoy.plans.registry import q_ingest_malformed

    kinds = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
    rows = [(i, i % 70, "O", 1.0, datetime(2000, 1, 1 + i % 28), kinds[i % 4]) for i in range(4000)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(os.path.join(tmp_dir, "orders.parquet"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        for size in (3_000, 100_000_000):  # files cut into many splits, and all files in one
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = q_ingest_malformed(spark, tmp_dir).collect()
            assert len(got) == len({r["order_id"] for r in got}) == 3000
            low = sorted((tuple(r) for r in got if int(r["order_id"][1:]) < 3))
            assert low == [
                ("O0000000", "0", None, "order_date"), ("O0000001", None, "O0000001,2000-01-02 00:00:00", ""),
                ("O0000002", "2", "O0000002,2000-01-03 00:00:00,2,more", ""),
            ]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
