"""End-to-end jobs: publish the layered tables of both pipelines and run the raw-vs-curated
comparison, as the original programs do.

Each layer is read back from the tables written by the layer below, so a published table is
exactly what later layers (and users) see, and lineage is cut between layers.

Partition layouts follow the source where that scales.  Directories per vehicle are not used:
a vehicle-first layout is a date/status partitioning whose files hold contiguous vehicle
ranges (``cluster_by``), which gives vehicle-selective reads through parquet statistics
without one directory per vehicle, date and status.
"""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.operators.intervals import Buckets
from convoy.operators.normalise import normalise_orders, normalise_telemetry
from convoy.operators.tables import TableSpec, read_table, write_layouts, write_table
from convoy.plans import deliveries as dl
from convoy.plans import fleet as fl
from convoy.operators.typed import typed_with_rejects
from convoy.session import materialize, staging
from convoy.sources import files
from convoy.sources.arrays import scan_json_array

# Table specs of the scaled pipeline: name -> (record key, ordering field, partitions, cluster).
RAW_LAYOUTS = {
    "raw_vehicle_partition": TableSpec(
        "raw_vehicle_partition", "order_id", "order_date", ("order_status", "order_date"), cluster_by=("vehicle_id",)
    ),
    "raw_status_partition": TableSpec("raw_status_partition", "order_id", "order_date", ("order_status", "order_date")),
    "raw_date_partition": TableSpec("raw_date_partition", "order_id", "order_date", ("order_date", "order_status")),
}
BY_DATE_STATUS = ("order_date", "order_status")
DELIVERY_SPECS = {
    "pending_raw_date_partition": TableSpec("pending_raw_date_partition", "order_id", "order_date", BY_DATE_STATUS),
    "orders": TableSpec("orders", "order_id", "order_date", BY_DATE_STATUS),
    "ml_orders": TableSpec("ml_orders", "order_id", "order_date", BY_DATE_STATUS),
    "compliance_orders": TableSpec("compliance_orders", "order_id", "order_date", BY_DATE_STATUS),
    # keys widened so that one row per (date, status) and per (date, vehicle) survives (D1, D2)
    "sales_dashboard": TableSpec("sales_dashboard", BY_DATE_STATUS, "order_date", BY_DATE_STATUS),
    "pending_orders_dashboard": TableSpec("pending_orders_dashboard", "order_id", "order_date", BY_DATE_STATUS),
    "compliance_check": TableSpec(
        "compliance_check", ("order_date", "vehicle_id"), "order_date", ("order_date",), cluster_by=("vehicle_id",)
    ),
}
FLEET_SPEC = TableSpec("bronze_layer", "order_id", "delivery_end_time", (), cluster_by=("delivery_status", "vehicle_id"))


def _path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def publish_deliveries(
    spark: SparkSession,
    shipments: DataFrame,
    telemetry: DataFrame,
    root: str,
    bucket_seconds: float | Buckets | None = None,
) -> dict[str, str]:
    """bronze (three layouts of the enriched orders, pending orders) -> silver -> gold."""
    with staging(spark):
        return _publish_deliveries(spark, shipments, telemetry, root, bucket_seconds)


def _publish_deliveries(spark, shipments, telemetry, root, bucket_seconds) -> dict[str, str]:
    paths = write_layouts(
        dl.enriched_orders(shipments, telemetry, bucket_seconds), RAW_LAYOUTS, f"{root.rstrip('/')}/bronze_layer"
    )

    def put(df: DataFrame, layer: str, name: str, unique: bool = False) -> DataFrame:
        paths[name] = write_table(df, DELIVERY_SPECS[name], _path(root, layer, name), assume_unique=unique)
        return read_table(spark, paths[name])

    # "unique": rows unique by the table key by construction (filters and projections of a
    # keyed table, aggregates grouped by exactly the key), so the dedupe shuffle is skipped
    raw = read_table(spark, paths["raw_date_partition"])
    pending = put(dl.pending_orders(shipments), "bronze_layer", "pending_raw_date_partition")
    silver = put(dl.silver_orders(raw, pending), "silver_layer", "orders")
    put(dl.ml_orders(raw), "silver_layer", "ml_orders", unique=True)
    compliance = put(dl.compliance_orders(raw), "silver_layer", "compliance_orders", unique=True)
    put(dl.sales_dashboard(silver), "gold_layer", "sales_dashboard", unique=True)
    put(dl.open_orders(silver), "gold_layer", "pending_orders_dashboard", unique=True)
    put(dl.compliance_check(compliance), "gold_layer", "compliance_check", unique=True)
    return paths


def publish_fleet(
    spark: SparkSession,
    parcels: DataFrame,
    samples: DataFrame,
    root: str,
    bucket_seconds: float | Buckets | None = None,
    as_of: str = fl.DAILY_AS_OF,
) -> dict[str, str]:
    """base (plain parquet hand-off file) -> bronze_layer -> silver (transit, successful) -> gold
    (daily, speeding, finances, alerts)."""
    with staging(spark):
        return _publish_fleet(spark, parcels, samples, root, bucket_seconds, as_of)


def _publish_fleet(spark, parcels, samples, root, bucket_seconds, as_of) -> dict[str, str]:
    paths: dict[str, str] = {}

    def put(df: DataFrame, layer: str, name: str, unique: bool = True) -> DataFrame:
        spec = replace(FLEET_SPEC, name=name)
        paths[name] = write_table(df, spec, _path(root, layer, name), assume_unique=unique)
        return read_table(spark, paths[name])

    # order_id numbers the rows, and every table below is a filter of them, so unique by it
    paths["base"] = files.sink_parquet_ms(fl.bronze(parcels, samples, bucket_seconds), f"{root.rstrip('/')}/base")
    bronze = put(files.scan_parquet(spark, paths["base"]), "bronze_layer", "bronze_layer")
    transit = put(fl.transit_orders(bronze), "silver_layer", "transit_orders")
    successful = put(fl.successful_orders(bronze), "silver_layer", "successful_orders")
    put(fl.daily_orders(bronze, as_of), "gold_layer", "daily_orders")
    put(fl.speed_inefficiency(transit), "gold_layer", "speed_inefficiency")
    put(fl.finances(successful), "gold_layer", "finances")
    put(fl.temperature_alerts(bronze), "gold_layer", "temperature_alerts")
    return paths


# The text columns of the input files and their types.
ORDER_TYPES = {
    "order_date": ("date", None),
    "delivery_latitude": ("float", None),
    "delivery_longitude": ("float", None),
    "delivery_start_datetime": ("timestamp", None),
    "delivery_end_datetime": ("timestamp", None),
}
TELEMETRY_TYPES = {
    "timestamp": ("timestamp", None),
    **{c: ("float", None) for c in ("latitude", "longitude", *dl.SENSORS)},
}
SAMPLE_SCHEMA = (
    "vehicle bigint, latitude double, longitude double, battery_temperature double, engine_temperature double, "
    "speed double, fuel_level double, tire_pressure double, timestamp bigint"
)
PARCEL_TYPES = {"delivery_time": ("bigint", None), "delivery_cost": ("double", None)}


#: Column of the rejects with the whole line, where its number of fields was wrong.
LINE = "malformed_line"


def _typed(scanned: DataFrame, types: dict, root: str, name: str) -> DataFrame:
    """The typed rows, parsed and staged once for all their readers; rows with text that does not
    convert or a wrong number of fields are also written to ``<root>/rejects/<name>``."""
    typed, rejects = typed_with_rejects(scanned, types, malformed=LINE, stage=name)
    rejects.write.mode("overwrite").parquet(f"{root.rstrip('/')}/rejects/{name}")
    return typed


def deliveries_from_files(
    spark: SparkSession, orders: str, telemetry: str, root: str, bucket_seconds: float | Buckets | None = None
) -> dict[str, str]:
    """The scaled pipeline from its raw inputs, orders CSV and telemetry CSV (all text, with
    header): cast with rejects, then publish."""
    with staging(spark):
        shipments = _typed(files.scan_csv(spark, orders, malformed=LINE), ORDER_TYPES, root, "orders")
        samples = _typed(files.scan_csv(spark, telemetry, malformed=LINE), TELEMETRY_TYPES, root, "telemetry")
        return publish_deliveries(
            spark, shipments, samples.withColumnRenamed("timestamp", "sample_ts"), root, bucket_seconds
        )


def fleet_from_files(
    spark: SparkSession, orders: str, telemetry: str, root: str, multiline: bool = False,
    bucket_seconds: float | Buckets | None = None, as_of: str = fl.DAILY_AS_OF,
) -> dict[str, str]:
    """The small pipeline from its raw inputs: orders CSV, whose row order is the delivery order,
    and telemetry JSON (``multiline``: files that each hold one array).  A record that names no
    vehicle belongs to vehicle 1."""
    with staging(spark):
        rows = files.in_file_order(files.scan_csv(spark, orders, malformed=LINE))
        parcels = normalise_orders(_typed(rows, PARCEL_TYPES, root, "orders"), keep=("seq",))
        scan = scan_json_array if multiline else files.scan_json
        raw = scan(spark, telemetry, SAMPLE_SCHEMA)
        samples = normalise_telemetry(raw, vehicle_id=F.coalesce("vehicle", F.lit(1).cast("bigint")))
        return publish_fleet(spark, parcels, materialize(samples, "samples")[0], root, bucket_seconds, as_of)


def compare_files(spark: SparkSession, orders: str, telemetry: str, root: str, as_of: str) -> dict[str, float]:
    """``compare`` from the raw files of the scaled pipeline, read and cast anew by each raw question."""
    shipments, _ = typed_with_rejects(files.scan_csv(spark, orders), ORDER_TYPES)
    samples, _ = typed_with_rejects(files.scan_csv(spark, telemetry), TELEMETRY_TYPES)
    return compare(spark, shipments, samples.withColumnRenamed("timestamp", "sample_ts"), root, as_of)


def compare(
    spark: SparkSession, shipments: DataFrame, telemetry: DataFrame, root: str, as_of: str
) -> dict[str, float]:
    """The two business questions answered from raw inputs and from the published tables,
    each computed in full (noop sink) and timed separately."""
    gold = read_table(spark, _path(root, "gold_layer", "sales_dashboard"))
    ml = read_table(spark, _path(root, "silver_layer", "ml_orders"))
    questions = {
        "daily_status_counts_raw": dl.daily_status_counts(shipments, as_of),
        "daily_status_counts_curated": dl.daily_status_counts_curated(gold, as_of),
        "delivered_with_telemetry_raw": dl.delivered_samples(shipments, telemetry),
        "delivered_with_telemetry_curated": ml.select(*dl.ML_COLUMNS),
    }
    out = {}
    for name, df in questions.items():
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t0, 3)
    return out
