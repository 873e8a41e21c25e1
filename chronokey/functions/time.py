"""Time helpers: all event-time arithmetic is done on epoch microseconds."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "ms": 1_000,
    "second": 1_000_000,
    "s": 1_000_000,
    "minute": 60_000_000,
    "min": 60_000_000,
    "hour": 3_600_000_000,
    "h": 3_600_000_000,
    "day": 86_400_000_000,
    "d": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(d) -> int:
    """A duration as integer microseconds.

    Accepts ``timedelta``, an int (milliseconds, the unit of the original
    demos) or text such as ``"15 minutes"`` / ``"1 day"``.
    """
    if isinstance(d, dt.timedelta):
        return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds
    if isinstance(d, int):
        return d * 1_000
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", str(d))
    if not m or m.group(2).lower() not in _UNIT_US:
        raise ValueError(f"unsupported duration: {d!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2).lower()]


def epoch_us(col) -> Column:
    """``TIMESTAMP`` (or zone-less timestamp, read as UTC) -> epoch microseconds."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def from_epoch_us(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(c)


def window_floor(us_col: Column, width_us: int) -> Column:
    """Start of the epoch-aligned tumbling window containing ``us_col``."""
    return us_col - F.pmod(us_col, F.lit(width_us))
