"""Scaled pipeline: orders with delivery windows matched to vehicle telemetry.

raw inputs -> interval join -> per-order means (bronze) -> silver tables -> gold tables.
Every function takes and returns DataFrames; nothing is written here (see
``convoy.plans.publish`` for the table writes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.operators.intervals import Buckets, interval_averages, interval_join, interval_means

# Sensor columns, order attributes and status names of the source.
SENSORS = ("fuel_level", "engine_temperature", "battery_temperature", "speed")
ORDER_COLUMNS = (
    "order_id",
    "order_status",
    "order_date",
    "delivery_latitude",
    "delivery_longitude",
    "delivery_start_datetime",
    "delivery_end_datetime",
    "vehicle_id",
)
PENDING, IN_TRANSIT, DELIVERED = "pending", "in transit", "delivered"
# Silver column lists, in the published order.
SILVER_ORDER_COLUMNS = ("order_id", "order_date", "order_status", "vehicle_id", *SENSORS)
ML_COLUMNS = (*SILVER_ORDER_COLUMNS, "delivery_start_datetime", "delivery_end_datetime")

def telemetry_pairs(
    shipments: DataFrame, telemetry: DataFrame, bucket_seconds: float | Buckets | None = None,
    method: str = "auto", salt: int = 1, lane_rows: int | None = None,
) -> DataFrame:
    """One row per (order, sample) with the sample inside the order's window on its vehicle.  The
    bucket width is derived from the data unless given (see ``intervals.derive_buckets``)."""
    return interval_join(
        shipments,
        telemetry,
        start="delivery_start_datetime",
        end="delivery_end_datetime",
        at="sample_ts",
        on=("vehicle_id",),
        bucket_seconds=bucket_seconds,
        method=method,
        salt=salt,
        lane_rows=lane_rows,
    )


def enriched_orders(
    shipments: DataFrame, telemetry: DataFrame, bucket_seconds: float | Buckets | None = None,
    method: str = "auto", salt: int = 1, lane_rows: int | None = None,
) -> DataFrame:
    """Per-order mean of each sensor over the samples in the window (orders without a
    sample are not in the result).  Grouped by all order attributes, as published.

    Windows that hold whole time buckets take the buckets' sums (``intervals.interval_averages``).
    ``method="prefix"`` takes the means from running sums; neither makes a row per (order, sample)."""
    if method == "prefix":
        return interval_means(
            shipments.select(*ORDER_COLUMNS).distinct(),
            telemetry,
            start="delivery_start_datetime",
            end="delivery_end_datetime",
            at="sample_ts",
            on=("vehicle_id",),
            measures=SENSORS,
        )
    return interval_averages(
        shipments.select(*ORDER_COLUMNS),
        telemetry,
        start="delivery_start_datetime",
        end="delivery_end_datetime",
        at="sample_ts",
        on=("vehicle_id",),
        measures=SENSORS,
        bucket_seconds=bucket_seconds,
        method=method,
        salt=salt,
        lane_rows=lane_rows,
    )


def pending_orders(shipments: DataFrame) -> DataFrame:
    return shipments.filter(F.col("order_status") == PENDING)


def unmatched_orders(shipments: DataFrame, enriched: DataFrame) -> DataFrame:
    """Orders that are not pending but found no telemetry: they vanish from the silver
    tables, which is why raw and curated daily counts differ."""
    return shipments.filter(F.col("order_status") != PENDING).join(
        enriched.select("order_id"), "order_id", "left_anti"
    )


def silver_orders(enriched: DataFrame, pending: DataFrame) -> DataFrame:
    """UNION (distinct) of enriched orders and pending orders padded with NULL telemetry."""
    left = enriched.select(*SILVER_ORDER_COLUMNS)
    right = pending.select(
        "order_id",
        "order_date",
        "order_status",
        *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in SILVER_ORDER_COLUMNS[3:]],
    )
    return left.unionByName(right).distinct()


def ml_orders(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("order_status") == DELIVERED).select(*ML_COLUMNS)


def compliance_orders(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("order_status").isin(DELIVERED, IN_TRANSIT)).select(*ML_COLUMNS)


def sales_dashboard(silver: DataFrame) -> DataFrame:
    return silver.groupBy("order_date", "order_status").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("vehicle_id").alias("vehicle_count"),
    )


def open_orders(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("order_status").isin(PENDING, IN_TRANSIT)).select(
        "order_date", "order_id", "order_status", "vehicle_id"
    )


# Compliance thresholds.
FUEL_MIN = 40
ENGINE_MAX = 40
BATTERY_MAX = 30
SPEED_MAX = 50


def compliance_check(compliance: DataFrame) -> DataFrame:
    """Per (order date, vehicle): three flags from the unweighted mean of the order means.
    A flag whose mean is NULL falls to the ELSE branch (fuel false, the others true)."""
    fuel = F.avg("fuel_level")
    engine = F.avg("engine_temperature")
    battery = F.avg("battery_temperature")
    speed = F.avg("speed")
    return compliance.groupBy("order_date", "vehicle_id").agg(
        F.when(fuel >= FUEL_MIN, True).otherwise(False).alias("fuel_compliant"),
        F.when((engine > ENGINE_MAX) | (battery > BATTERY_MAX), False).otherwise(True).alias(
            "temperature_compliant"
        ),
        F.when(speed > SPEED_MAX, False).otherwise(True).alias("speed_compliant"),
    )


def daily_status_counts(shipments: DataFrame, as_of: str) -> DataFrame:
    """Raw: distinct orders per status on one order date."""
    return (
        shipments.filter(F.col("order_date") == F.lit(as_of).cast("date"))
        .groupBy("order_status")
        .agg(F.count_distinct("order_id").alias("order_count"))
    )


def daily_status_counts_curated(dashboard: DataFrame, as_of: str) -> DataFrame:
    """Curated: the same question answered from the gold dashboard table."""
    return dashboard.filter(F.col("order_date") == F.lit(as_of).cast("date")).select(
        "order_status", "order_count"
    )


def delivered_samples(
    shipments: DataFrame, telemetry: DataFrame, bucket_seconds: float | Buckets | None = None
) -> DataFrame:
    """Raw: every (delivered order, sample) pair, sample grain, ten columns."""
    delivered = shipments.filter(F.col("order_status") == DELIVERED)
    return telemetry_pairs(delivered, telemetry, bucket_seconds).select(*ML_COLUMNS)

