"""Time parsing and conversion.

Timestamps are kept as ``timestamp_ntz`` (wall-clock, no zone) throughout, so results do not
depend on the session time zone.  Epoch seconds are read as UTC wall-clock time.

Two parse modes are offered wherever input can be malformed:

* ``"permissive"``: malformed text gives NULL (the behaviour of Spark 3.x without ANSI).
* ``"strict"``: malformed text fails the job (the behaviour of a parser that raises).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parse patterns of the source formats.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
US_DATE_PATTERN = "M/d/yyyy"

EPOCH_NTZ = "1970-01-01 00:00:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict(text: Column, parsed: Column, what: str) -> Column:
    """``parsed``, but fail the job when ``text`` is present and did not convert.  Explicit, so
    strict mode does not depend on the session's ANSI setting."""
    bad = text.isNotNull() & (F.trim(text.cast("string")) != "") & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"cannot convert to {what}: "), text.cast("string")))).otherwise(parsed)


def ntz(text: str) -> Column:
    """A ``timestamp_ntz`` literal."""
    return F.expr(f"timestamp_ntz'{text}'")


def timestamp_micros_sql(name: str) -> str:
    """SQL text of ``timestamp_micros`` for a column name (one expression, parsed JVM-side)."""
    c = f"`{name}`"
    return (
        f"(cast(unix_date(to_date({c})) AS bigint) * 86400000000L"
        f" + cast(hour({c}) AS bigint) * 3600000000L + cast(minute({c}) AS bigint) * 60000000L"
        f" + cast(date_part('SECOND', {c}) * 1000000 AS bigint))"
    )


def timestamp_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz``, computed from its calendar
    fields so that no session time zone (and no daylight-saving gap) is involved."""
    if isinstance(c, str):
        return F.expr(timestamp_micros_sql(c))
    c = _col(c)
    day_us = F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
    clock_us = F.hour(c).cast("long") * F.lit(3_600_000_000) + F.minute(c).cast("long") * F.lit(60_000_000)
    second_us = (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long")
    return day_us + clock_us + second_us


def epoch_to_timestamp(c: Column | str, mode: str = "permissive", is_text: bool = False) -> Column:
    """Epoch seconds (number, or digit text when ``is_text``) to UTC ``timestamp_ntz``.

    Fractional seconds are truncated, as an integer conversion does.
    """
    c = _col(c)
    seconds = c.try_cast("bigint") if is_text else c.cast("bigint")
    if mode == "strict" and is_text:
        seconds = strict(c, seconds, "epoch seconds")
    return F.timestamp_add("SECOND", seconds, ntz(EPOCH_NTZ))


def parse_timestamp(c: Column | str, pattern: str = TIMESTAMP_PATTERN, mode: str = "permissive") -> Column:
    """Text to ``timestamp_ntz``; the default pattern accepts an optional 6-digit fraction."""
    c = _col(c)
    # try_to_timestamp decides parseability; the NTZ parse only runs on parseable text
    parsed = F.when(F.try_to_timestamp(c, F.lit(pattern)).isNotNull(), F.to_timestamp_ntz(c, F.lit(pattern)))
    return strict(c, parsed, "timestamp") if mode == "strict" else parsed


def parse_date(c: Column | str, pattern: str = TIMESTAMP_PATTERN, mode: str = "permissive") -> Column:
    """Text to ``date`` using a timestamp pattern (time of day is dropped)."""
    c = _col(c)
    parsed = F.try_to_date(c, pattern)
    return strict(c, parsed, "date") if mode == "strict" else parsed


def parse_us_date(c: Column | str, mode: str = "permissive") -> Column:
    """``m/d/Y`` text to ``date``; one-digit month and day are accepted."""
    return parse_date(c, US_DATE_PATTERN, mode)


def event_date(c: Column | str) -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(_col(c))


def truncate_to_millis(c: Column | str) -> Column:
    """Cut a ``timestamp_ntz`` to milliseconds and keep it zone-free."""
    return F.date_trunc("MILLISECOND", _col(c)).cast("timestamp_ntz")
