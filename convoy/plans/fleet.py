"""Small pipeline: chained delivery windows, left enrichment with telemetry means, and the
bronze / silver / gold tables filtered from it.

The original ran these steps in pandas loops on one machine; here each step is a Spark
operator: the chain is a blocked running sum, the enrichment a bucketed interval join
followed by two hash aggregates and a left join, the order id a blocked row number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.functions.time import epoch_to_timestamp
from convoy.operators.intervals import Buckets, derive_buckets, window_enrich_left
from convoy.operators.sequence import accumulate
from convoy.session import materialize as stage

# The first window starts at epoch 1704085200 = 2024-01-01 05:00:00 UTC.
CHAIN_START_EPOCH = 1704085200
SENSORS = ("battery_temperature", "engine_temperature", "speed", "fuel_level")
GROUP_KEYS = ("vehicle_id", "event_date")
IN_TRANSIT, PENDING, DELIVERED = "in transit", "pending", "delivered"
DAILY_AS_OF = "2024-01-01"  # the "today" of the daily orders table

# The enrichment joins on the time bucket alone (any vehicle's samples count), so a moment at
# which the whole fleet reports is one key.  The operator splits such buckets into lanes; ``salt`` deals the
# samples of every bucket over so many lanes, at the price of as many copies of each window.
SALT = 1

def chained_windows(
    parcels: DataFrame, seq: str = "seq", duration: str = "delivery_time", number_as: str | None = None,
    partition_by: tuple[str, ...] = (), strict: bool = False,
) -> DataFrame:
    """Windows laid end to end in ``seq`` order: the end of order i is the chain start plus
    the durations of orders 1..i; its start is the end of order i-1.  A NULL duration gives a
    NULL end and is skipped by later orders.  ``number_as`` also numbers the orders 1..n in
    the same pass.  ``partition_by`` lays a chain (and numbers) per group, such as the vehicle.
    ``strict``: an order without a duration makes the job fail instead."""
    if strict:
        missing = F.raise_error(F.concat(F.lit("no duration for order "), F.col(seq).cast("string"))).cast("bigint")
        parcels = parcels.withColumn(duration, F.when(F.col(duration).isNull(), missing).otherwise(F.col(duration)))
    d = accumulate(parcels, seq, sums={"__elapsed": duration}, row_number=number_as, partition_by=tuple(partition_by))
    end_epoch = F.lit(CHAIN_START_EPOCH).cast("bigint") + F.col("__elapsed")
    return (
        d.withColumn("delivery_end_epoch", end_epoch)
        .withColumn("delivery_end_time", epoch_to_timestamp(F.col("delivery_end_epoch")))
        .drop("__elapsed")
    )


def with_event_date(samples: DataFrame, ts: str = "timestamp") -> DataFrame:
    return samples.withColumn("event_date", F.to_date(F.col(ts)))


def daily_vehicle_means(samples: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Mean of each sensor per (vehicle, date); samples with a NULL key are left out."""
    s = with_event_date(samples, ts).filter(F.col("vehicle_id").isNotNull() & F.col("event_date").isNotNull())
    return s.groupBy(*GROUP_KEYS).agg(*[F.avg(c).alias(c) for c in SENSORS])


def enrich_windows(
    chained: DataFrame, samples: DataFrame, key: str = "seq", bucket_seconds: float | Buckets | None = None,
    salt: int = SALT, groups: str = "first",
) -> DataFrame:
    """Attach, per order, the sensor means of the first (vehicle, date) group of the samples
    inside ``[end - duration, end]``; orders without samples keep NULL means.  ``groups="all"``: a row
    per order and group."""
    iv = _with_start(chained)
    out = window_enrich_left(
        iv,
        with_event_date(samples),
        key=key,
        start="__start",
        end="delivery_end_time",
        at="timestamp",
        group_by=GROUP_KEYS,
        measures=SENSORS,
        bucket_seconds=bucket_seconds,
        salt=salt,
        groups=groups,
    )
    return out.drop("__start")


def _with_start(chained: DataFrame) -> DataFrame:
    return chained.withColumn(
        "__start", F.timestamp_add("SECOND", -F.col("delivery_time"), F.col("delivery_end_time"))
    )


def numbered_chain(parcels: DataFrame) -> DataFrame:
    """Chained windows numbered 1..n in file order as ``order_id``, staged once as parquet in the
    session's checkpoint folder: the chain feeds both sides of the enrichment, and every table
    below it, so it is computed once and lineage is cut there."""
    return stage(chained_windows(parcels, number_as="order_id"), "chained_orders")[0]


def bronze(
    parcels: DataFrame, samples: DataFrame, bucket_seconds: float | Buckets | None = None, salt: int = SALT
) -> DataFrame:
    """The numbered chain, enriched."""
    return bronze_of(numbered_chain(parcels), samples, bucket_seconds, salt)


def bronze_of(
    chained: DataFrame, samples: DataFrame, bucket_seconds: float | Buckets | None = None, salt: int = SALT
) -> DataFrame:
    """Bronze rows of these orders.  The enrichment works on each order by itself, so a filter on
    order columns may come before it."""
    enriched = enrich_windows(chained, samples, bucket_seconds=bucket_seconds, salt=salt)
    return enriched.select(*[c for c in enriched.columns if c != "order_id"], "order_id")


def orders_with_status(orders: DataFrame, status: str = IN_TRANSIT) -> DataFrame:
    """The status question: orders of exactly this status (an unknown status is no status)."""
    return orders.filter(F.col("delivery_status") == status)


def transit_orders(bronze_df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Open orders whose ``required`` columns (by default all) are known."""
    return bronze_df.filter(F.col("delivery_status").isin(IN_TRANSIT, PENDING)).na.drop("any", subset=required)


def successful_orders(bronze_df: DataFrame) -> DataFrame:
    return bronze_df.filter(F.col("delivery_status").isin(DELIVERED)).na.drop("any")


def daily_orders(bronze_df: DataFrame, as_of: str = DAILY_AS_OF) -> DataFrame:
    return bronze_df.filter(F.col("order_date") == F.lit(as_of).cast("date")).na.drop("any")


def speed_inefficiency(transit: DataFrame) -> DataFrame:
    return transit.filter(F.col("speed") > 50).na.drop("any")


def finances(successful: DataFrame) -> DataFrame:
    return successful.na.drop("any")


def temperature_alerts(bronze_df: DataFrame) -> DataFrame:
    return bronze_df.filter((F.col("battery_temperature") > 30) | (F.col("engine_temperature") > 40)).na.drop("any")


def build(parcels: DataFrame, samples: DataFrame, bucket_seconds: float | Buckets | None = None, salt: int = SALT):
    """All tables of the small pipeline as lazy DataFrames, keyed by published name.  Tables of one
    status or date enrich only the orders they keep."""
    chained = numbered_chain(parcels)
    if bucket_seconds is None:
        bucket_seconds = derive_buckets(
            _with_start(chained), samples, start="__start", end="delivery_end_time", at="timestamp"
        )

    def b(only: str = "true") -> DataFrame:
        return bronze_of(chained.where(only), samples, bucket_seconds, salt)

    transit = transit_orders(b(f"delivery_status IN ('{IN_TRANSIT}', '{PENDING}')"))
    successful = successful_orders(b(f"delivery_status = '{DELIVERED}'"))
    return {
        "bronze_layer": b(),
        "transit_orders": transit,
        "successful_orders": successful,
        "daily_orders": daily_orders(b(f"order_date = date'{DAILY_AS_OF}'")),
        "speed_inefficiency": speed_inefficiency(transit),
        "finances": finances(successful),
        "temperature_alerts": temperature_alerts(b()),
    }
