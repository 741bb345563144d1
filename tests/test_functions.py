from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from convoy.functions import (
    cast_columns,
    epoch_to_timestamp,
    flatten_struct,
    location_text,
    pad_columns,
    parse_date,
    parse_timestamp,
    parse_us_date,
    timestamp_micros,
    truncate_to_millis,
    zfill,
    zfill_int,
)


def test_parse_timestamp_optional_fraction_and_modes(spark):
    df = spark.createDataFrame([("2024-01-05 10:11:12.123456",), ("2024-01-05 10:11:12",), ("junk",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [datetime(2024, 1, 5, 10, 11, 12, 123456), datetime(2024, 1, 5, 10, 11, 12), None, None, None]
    assert df.select(parse_timestamp("s")).schema[0].dataType.simpleString() == "timestamp_ntz"
    with pytest.raises(Exception):
        df.select(parse_timestamp("s", mode="strict")).collect()


def test_dates(spark):
    df = spark.createDataFrame([("1/5/2024",), ("01/15/2024",), ("2024-01-05",)], "s string")
    assert [r[0] for r in df.select(parse_us_date("s")).collect()] == [date(2024, 1, 5), date(2024, 1, 15), None]
    ts = spark.createDataFrame([("2024-03-17 23:59:59.5",)], "s string")
    assert ts.select(parse_date("s")).first()[0] == date(2024, 3, 17)


def test_epoch_and_micros(spark):
    df = spark.createDataFrame([(1704085200, "1704085200", 1704085200.9)], "i long, s string, f double")
    r = df.select(
        epoch_to_timestamp("i"), epoch_to_timestamp("s", is_text=True), epoch_to_timestamp("f"),
        timestamp_micros(epoch_to_timestamp("i")),
    ).first()
    assert r[0] == r[1] == r[2] == datetime(2024, 1, 1, 5, 0, 0)
    assert r[3] == 1704085200 * 1_000_000


def test_micros_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-03-10 03:10:00",)], "s string")
        m = [r[0] for r in df.select(timestamp_micros(F.to_timestamp_ntz("s"))).collect()]
        assert m[1] - m[0] == 40 * 60 * 1_000_000  # wall-clock difference, no DST gap
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_text_helpers(spark):
    df = spark.createDataFrame([(7, -89.75, 12.0), (12345678, None, 1.5)], "k long, lat double, lon double")
    r = df.select(zfill_int("k", 5, "V"), zfill("k", 5), location_text("lat", "lon")).collect()
    assert [tuple(x) for x in r] == [("V00007", "00007", "-89.75,12.0"), ("V12345678", "12345678", None)]


def test_casts_pad_flatten_millis(spark):
    df = spark.createDataFrame([("1.5", "junk")], "a string, b string")
    assert tuple(cast_columns(df, ["a", "b"]).first()) == (1.5, None)
    like = spark.createDataFrame([], "a string, x double, y date")
    padded = pad_columns(df, like)
    assert padded.columns == ["a", "x", "y"] and padded.first()["x"] is None
    nested = spark.createDataFrame([((1, (2, 3)), [4])], "s struct<a:int, b:struct<c:int, d:int>>, arr array<int>")
    flat = flatten_struct(nested)
    assert flat.columns == ["s.a", "s.b.c", "s.b.d", "arr"] and tuple(flat.first()) == (1, 2, 3, [4])
    t = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 123456),)], "t timestamp_ntz")
    r = t.select(truncate_to_millis("t").alias("m"))
    assert r.first()[0] == datetime(2024, 1, 1, 0, 0, 0, 123000) and r.schema[0].dataType.simpleString() == "timestamp_ntz"


def test_typed_with_rejects(spark):
    from convoy.operators.typed import typed_with_rejects

    df = spark.createDataFrame(
        [("2024-01-05 10:11:12", "1.5"), ("05.01.2024", "x"), ("", None), ("2024-01-05 10:11:12.5", "2")],
        "ts string, v string",
    )
    typed, rejects = typed_with_rejects(df, {"ts": ("timestamp", None), "v": ("float", None)})
    assert typed.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert [r["v"] for r in typed.collect()] == [1.5, None, None, 2.0]
    rej = [(r["ts"], r["rejected_columns"]) for r in rejects.collect()]
    assert rej == [("05.01.2024", ["ts", "v"])]  # empty text is missing, not rejected
    with pytest.raises(Exception):
        typed_with_rejects(df, {"v": ("float", None)}, mode="strict")[0].collect()


def test_strict_telemetry_requires_timestamp(spark):
    from convoy.operators.normalise import normalise_telemetry

    df = spark.createDataFrame([(1.0, None)], "speed double, timestamp bigint")
    assert normalise_telemetry(df).first()["timestamp"] is None
    with pytest.raises(Exception):
        normalise_telemetry(df, mode="strict").collect()


def test_strict_mode_without_ansi(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        df = spark.createDataFrame([("2024-01-05 10:11:12", "1/5/2024", "1.5")], "t string, d string, f string")
        ok = df.select(parse_timestamp("t", mode="strict"), parse_us_date("d", mode="strict")).first()
        assert ok[0] == datetime(2024, 1, 5, 10, 11, 12) and ok[1] == date(2024, 1, 5)
        bad = spark.createDataFrame([("junk", "13/45/2024", "x")], "t string, d string, f string")
        for col in (parse_timestamp("t", mode="strict"), parse_us_date("d", mode="strict")):
            with pytest.raises(Exception):
                bad.select(col).collect()
        with pytest.raises(Exception):
            cast_columns(bad, ["f"], mode="strict").collect()
        assert cast_columns(bad, ["f"]).first()["f"] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
