"""Inputs of the reference's shape, derived by Spark from the testdata tables.

The reference ships no data.  These views stand in for its four inputs and grow with the
testdata: every row of ``events`` becomes one telemetry sample and every row of ``orders``
becomes one delivery order (no row subsets).  The DuckDB twins of these definitions live in
``convoy.plans.oracles`` and must be kept in step.

* ``telemetry``   scaled-pipeline telemetry (one vehicle per ``user_id``)
* ``shipments``   scaled-pipeline orders with a delivery window on one vehicle
* ``raw_parcels`` small-pipeline order records (text date ``m/d/Y``), ``parcels`` normalised
* ``raw_samples`` small-pipeline telemetry records (epoch seconds), ``samples`` normalised
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions.text import zfill_int
from convoy.functions.time import timestamp_micros_sql

# Fixed values of the fixture derivation (shared with the DuckDB twins).
FIXTURE_START = "2024-01-01 00:00:00"  # first order minute
ORDER_MINUTES = 43200  # orders are spread over 30 days of minutes
WINDOW_BASE_MINUTES = 360  # every delivery window lasts 6 h ...
WINDOW_STEP_MINUTES = 60  # ... plus 0..42 more hours
WINDOW_STEPS = 43
SMALL_FLEET = 3  # vehicles in the small-pipeline telemetry
REFERENCE_FLEET = 50  # the original generator's fleet size (dense variant of the scaled inputs)


# The declared schemas of the two testdata tables the fixtures read.  Passing
# them skips schema inference (a footer-reading job per scan) and pins the types.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_ORDER_START = f"timestamp_ntz'{FIXTURE_START}' + make_dt_interval(0, 0, cast((o_orderkey * 37) % {ORDER_MINUTES} AS int), 0)"
_STATUS = "CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'in transit' ELSE 'delivered' END"


def telemetry(spark: SparkSession, sf_dir: str, fleet: int | None = None) -> DataFrame:
    """One sample per ``events`` row; ``fleet`` folds the users onto that many vehicles."""
    vehicle = "user_id" if fleet is None else f"user_id % {int(fleet)}"
    return read_table(spark, sf_dir, "events").selectExpr(
        f"format_string('V%05d', {vehicle}) AS vehicle_id",
        "ts AS sample_ts",
        "cast((event_id * 13) % 101 AS double) AS fuel_level",
        "cast(25 + (event_id * 7) % 31 AS double) AS engine_temperature",
        "cast(20 + (event_id * 3) % 21 AS double) AS battery_temperature",
        "value AS speed",
        "cast(((event_id * 7) % 721) / 4.0 - 90.0 AS float) AS latitude",
        "cast(((event_id * 11) % 1441) / 4.0 - 180.0 AS float) AS longitude",
    )


def fleet_size(spark: SparkSession, sf_dir: str) -> Column:
    """Number of vehicles, as a lazily evaluated scalar subquery over ``events``."""
    return read_table(spark, sf_dir, "events").select((F.max("user_id") + 1).alias("n")).scalar()


def shipments(spark: SparkSession, sf_dir: str, fleet: int | None = None) -> DataFrame:
    size = fleet_size(spark, sf_dir) if fleet is None else F.lit(int(fleet)).cast("bigint")
    return shipments_from(read_table(spark, sf_dir, "orders"), size)


def shipments_from(o: DataFrame, fleet: Column) -> DataFrame:
    """Delivery orders from rows of ``orders``; ``fleet`` is the number of vehicles."""
    end_minutes = (
        f"(o_orderkey * 37) % {ORDER_MINUTES} + {WINDOW_BASE_MINUTES} + {WINDOW_STEP_MINUTES} * (o_orderkey % {WINDOW_STEPS})"
    )
    end = f"timestamp_ntz'{FIXTURE_START}' + make_dt_interval(0, 0, cast({end_minutes} AS int), 0)"
    return o.select(
        F.expr("format_string('O%07d', o_orderkey)").alias("order_id"),
        F.expr(_STATUS).alias("order_status"),
        F.expr(f"cast({_ORDER_START} AS date)").alias("order_date"),
        F.expr("cast(((o_orderkey * 7) % 721) / 4.0 - 90.0 AS float)").alias("delivery_latitude"),
        F.expr("cast(((o_orderkey * 11) % 1441) / 4.0 - 180.0 AS float)").alias("delivery_longitude"),
        F.expr(f"CASE WHEN o_orderstatus <> 'P' THEN {_ORDER_START} END").alias("delivery_start_datetime"),
        F.expr(f"CASE WHEN o_orderstatus <> 'P' THEN {end} END").alias("delivery_end_datetime"),
        F.when(F.col("o_orderstatus") != "P", zfill_int(F.col("o_custkey") % fleet, 5, "V")).alias("vehicle_id"),
    )


def raw_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records as the small CSV holds them; ``seq`` is the file order."""
    return read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS seq",
        "concat(cast(o_custkey AS string), ' Main Street') AS delivery_address",
        f"{_STATUS} AS delivery_status",
        "cast(60 + (o_orderkey * 37) % 240 AS bigint) AS delivery_time",
        "o_totalprice AS delivery_cost",
        "format_string('Customer#%09d', o_custkey) AS recipient_name",
        f"date_format({_ORDER_START}, 'M/d/yyyy') AS order_date",
    )


def raw_samples(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Telemetry records as the small JSON file holds them (epoch seconds, coordinates), and the
    columns ``keep`` of ``events``."""
    return read_table(spark, sf_dir, "events").selectExpr(
        *keep,
        f"user_id % {SMALL_FLEET} AS vehicle",
        "cast(((event_id * 7) % 721) / 4.0 - 90.0 AS double) AS latitude",
        "cast(((event_id * 11) % 1441) / 4.0 - 180.0 AS double) AS longitude",
        "cast(20 + (event_id * 3) % 21 AS double) AS battery_temperature",
        "cast(25 + (event_id * 7) % 31 AS double) AS engine_temperature",
        "value AS speed",
        "cast((event_id * 13) % 101 AS double) AS fuel_level",
        "cast(30.0 + ((event_id * 5) % 11) / 2.0 AS double) AS tire_pressure",
        f"{timestamp_micros_sql('ts')} div 1000000 AS timestamp",
    )


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from convoy.operators.normalise import normalise_orders

    return normalise_orders(raw_parcels(spark, sf_dir), keep=("seq",))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    from convoy.operators.normalise import normalise_telemetry

    return normalise_telemetry(raw_samples(spark, sf_dir), vehicle_id=F.col("vehicle"))
