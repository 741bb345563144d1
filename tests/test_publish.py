import os

from pyspark.sql import functions as F

from convoy.operators.tables import read_table
from convoy.plans import publish
from convoy.plans import registry as r
from convoy.sources import files
from convoy.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _rows(df, cols):
    return sorted(tuple(x) for x in r.rounded(df).select(*cols).collect())


def test_published_tables_equal_lazy_queries(spark, tmp_dir):
    paths = publish.publish_deliveries(spark, fx.shipments(spark, SF), fx.telemetry(spark, SF), tmp_dir)
    paths.update(publish.publish_fleet(spark, fx.parcels(spark, SF), fx.samples(spark, SF), tmp_dir))
    lazy = {
        "orders": r.q_silver_orders,
        "ml_orders": r.q_ml_orders,
        "compliance_orders": r.q_compliance_orders,
        "sales_dashboard": r.q_sales_dashboard,
        "pending_orders_dashboard": r.q_open_orders,
        "compliance_check": r.q_compliance_check,
        "raw_vehicle_partition": r.q_order_telemetry_means,
        "pending_raw_date_partition": r.q_pending_orders,
        "bronze_layer": r.QUERIES["fleet_bronze"],
        "transit_orders": r.QUERIES["fleet_transit"],
        "daily_orders": r.QUERIES["fleet_daily"],
        "speed_inefficiency": r.QUERIES["fleet_speeding"],
        "finances": r.QUERIES["fleet_finances"],
        "temperature_alerts": r.QUERIES["fleet_temperature_alerts"],
    }
    for name, q in lazy.items():
        want = q(spark, SF)
        got = read_table(spark, paths[name])
        assert _rows(got, want.columns) == _rows(want, want.columns), name
    times = publish.compare(spark, fx.shipments(spark, SF), fx.telemetry(spark, SF), tmp_dir, "2024-01-17")
    assert set(times) == {
        "daily_status_counts_raw", "daily_status_counts_curated",
        "delivered_with_telemetry_raw", "delivered_with_telemetry_curated",
    }


def test_compare_and_rejects_from_files(spark, tmp_dir):
    """The job and the comparison from CSV files, one order line cut short: it is published and listed."""
    t = fx.telemetry(spark, SF).withColumn("timestamp", F.date_format("sample_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    telemetry = files.sink_csv(t.drop("sample_ts"), os.path.join(tmp_dir, "telemetry"))
    orders = files.sink_csv(r._shipments_text(spark, SF), os.path.join(tmp_dir, "orders"))
    with open(os.path.join(orders, "part-cut.csv"), "w") as f:
        f.write(",".join(r._shipments_text(spark, SF).columns) + "\nO9999999,pending,2024-01-17 00:00:00.000000\n")
    root = os.path.join(tmp_dir, "root")
    paths = publish.deliveries_from_files(spark, orders, telemetry, root)
    assert read_table(spark, paths["orders"]).where("order_id = 'O9999999'").count() == 1
    listed = spark.read.parquet(os.path.join(root, "rejects", "orders")).collect()
    assert [(x["order_id"], x["malformed_line"]) for x in listed] == [("O9999999", "O9999999,pending,2024-01-17 00:00:00.000000")]
    times = publish.compare_files(spark, orders, telemetry, root, "2024-01-17")
    assert len(times) == 4 and all(v > 0 for v in times.values())


def test_staging_removes_stages(spark):
    from convoy.session import materialize, staging

    with staging(spark):
        df, path = materialize(spark.range(10), "t")
        assert df.count() == 10 and os.path.exists(path.replace("file:", ""))
    assert not os.path.exists(path.replace("file:", ""))
