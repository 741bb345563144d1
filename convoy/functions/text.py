"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zfill(c: Column | str, width: int) -> Column:
    """Left-pad the text of ``c`` with zeros to ``width``; longer text is kept whole (never cut)."""
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), "0")


def zfill_int(c: Column | str, width: int, prefix: str = "") -> Column:
    """``prefix`` + a non-negative integer with at least ``width`` digits (never cut)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.format_string(f"{prefix}%0{width}d", c)


def location_text(lat: Column | str, lon: Column | str) -> Column:
    """``"lat,lon"``; NULL when either coordinate is missing."""
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    # concat (not concat_ws) so that a missing side yields NULL instead of being skipped
    return F.concat(lat.cast("string"), F.lit(","), lon.cast("string"))
