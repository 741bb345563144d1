"""Column expressions.  Everything here returns a ``Column``; nothing runs Python per row."""

from convoy.functions.casts import cast_columns, flatten_struct, pad_columns
from convoy.functions.text import location_text, zfill, zfill_int
from convoy.functions.time import (
    EPOCH_NTZ,
    epoch_to_timestamp,
    event_date,
    ntz,
    parse_date,
    parse_timestamp,
    parse_us_date,
    timestamp_micros,
    truncate_to_millis,
)

__all__ = [
    "EPOCH_NTZ",
    "cast_columns",
    "epoch_to_timestamp",
    "event_date",
    "flatten_struct",
    "location_text",
    "ntz",
    "pad_columns",
    "parse_date",
    "parse_timestamp",
    "parse_us_date",
    "timestamp_micros",
    "truncate_to_millis",
    "zfill",
    "zfill_int",
]
