from datetime import date

from convoy.plans import deliveries as dl

COMP = "order_id string, order_date date, order_status string, vehicle_id string, fuel_level double, engine_temperature double, battery_temperature double, speed double"
D = date(2024, 1, 1)


def test_compliance_thresholds(spark):
    df = spark.createDataFrame(
        [
            ("a", D, "delivered", "V1", 40.0, 40.0, 30.0, 50.0),  # boundaries: >= fuel, > temps, > speed
            ("b", D, "delivered", "V2", 39.9, 40.1, 20.0, 50.1),
            ("c", D, "in transit", "V3", None, None, None, None),  # all NULL: fuel false, others true
            ("d", D, "delivered", "V4", 10.0, 20.0, 40.0, 0.0),
            ("e", D, "delivered", "V4", 90.0, 20.0, 10.0, 0.0),  # mean of order means: 50 / 20 / 25
        ],
        COMP,
    )
    got = {r["vehicle_id"]: tuple(r)[2:] for r in dl.compliance_check(df).collect()}
    assert got == {
        "V1": (True, True, True),
        "V2": (False, False, False),
        "V3": (False, True, True),
        "V4": (True, True, True),
    }


def test_silver_union_dashboard_and_open_orders(spark):
    enriched = spark.createDataFrame(
        [("o1", D, "delivered", "V1", 1.0, 2.0, 3.0, 4.0), ("o2", D, "in transit", "V1", 1.0, 2.0, 3.0, 4.0)], COMP
    ).withColumns({"delivery_start_datetime": dl.F.lit(None).cast("timestamp_ntz"), "delivery_end_datetime": dl.F.lit(None).cast("timestamp_ntz")})
    pending = spark.createDataFrame(
        [("o3", "pending", D, None, None, None), ("o3", "pending", D, None, None, None)],
        "order_id string, order_status string, order_date date, delivery_start_datetime timestamp_ntz, "
        "delivery_end_datetime timestamp_ntz, vehicle_id string",
    )
    silver = dl.silver_orders(enriched, pending)
    assert silver.count() == 3  # duplicate rows with NULLs collapse to one
    dash = {r["order_status"]: (r["order_count"], r["vehicle_count"]) for r in dl.sales_dashboard(silver).collect()}
    assert dash == {"delivered": (1, 1), "in transit": (1, 1), "pending": (1, 0)}
    assert sorted(r["order_id"] for r in dl.open_orders(silver).collect()) == ["o2", "o3"]
    cur = dl.daily_status_counts_curated(dl.sales_dashboard(silver), "2024-01-01")
    assert sorted(tuple(r) for r in cur.collect()) == [("delivered", 1), ("in transit", 1), ("pending", 1)]


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["order_date", "vehicle_id", "fuel_compliant", "temperature_compliant", "speed_compliant"]
    assert df.count() == 365
    assert set(e.oracle_sql()) <= set(e.queries())
