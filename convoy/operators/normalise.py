"""Record normalisation as one projection per source.

The per-record normalisers of the original pipeline become column expressions: each output
field is a function of the input columns, absent inputs give NULL (never ``""``), and the
constant fleet id is a literal column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.text import location_text
from convoy.functions.time import epoch_to_timestamp, parse_us_date

# The output fields of the two normalisers, in order.
TELEMETRY_FIELDS = (
    "location",
    "battery_temperature",
    "engine_temperature",
    "speed",
    "fuel_level",
    "tire_pressure",
    "timestamp",
)
ORDER_FIELDS = (
    "delivery_address",
    "delivery_status",
    "delivery_time",
    "delivery_cost",
    "recipient_name",
    "order_date",
)
SERVICE_FIELDS = ("maintenance_required", "last_service_date")


def _field(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None)


def normalise_telemetry(
    df: DataFrame,
    vehicle_id: Column | None = None,
    mode: str = "permissive",
    service_fields: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """location text, five pass-through sensors, epoch seconds to timestamp, fleet id.

    ``service_fields`` adds the two optional fields (flag pass-through, ``m/d/Y`` date).
    """
    ts = df.schema["timestamp"].dataType.simpleString() if "timestamp" in df.columns else "bigint"
    stamp = epoch_to_timestamp(_field(df, "timestamp"), mode=mode, is_text=(ts == "string"))
    if mode == "strict":
        # the timestamp is required: a record without one fails the job
        stamp = F.when(_field(df, "timestamp").isNull(), F.raise_error(F.lit("telemetry record without timestamp"))).otherwise(stamp)
    cols = [
        location_text(_field(df, "latitude"), _field(df, "longitude")).alias("location"),
        *[_field(df, f).alias(f) for f in TELEMETRY_FIELDS[1:6]],
        stamp.alias("timestamp"),
    ]
    if service_fields:
        cols += [
            _field(df, "maintenance_required").alias("maintenance_required"),
            parse_us_date(_field(df, "last_service_date").cast("string"), mode=mode).alias("last_service_date"),
        ]
    cols.append((vehicle_id if vehicle_id is not None else F.lit(1).cast("bigint")).alias("vehicle_id"))
    return df.select(*[F.col(k) for k in keep], *cols)


def normalise_orders(
    df: DataFrame,
    vehicle_id: Column | None = None,
    mode: str = "permissive",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Five pass-through order fields, ``m/d/Y`` order date, fleet id."""
    cols = [_field(df, f).alias(f) for f in ORDER_FIELDS[:-1]]
    cols.append(parse_us_date(_field(df, "order_date").cast("string"), mode=mode).alias("order_date"))
    cols.append((vehicle_id if vehicle_id is not None else F.lit(1).cast("bigint")).alias("vehicle_id"))
    return df.select(*[F.col(k) for k in keep], *cols)
