"""Time functions. The session zone is UTC; any other zone is an explicit argument."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sparkloom.functions.text import as_col

# Text patterns of the time grains.
GRAIN_PATTERNS = {"hour": "yyyyMMddHH", "day": "yyyyMMdd", "month": "yyyyMM"}
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
CLOCK = "HH:mm:ss"

_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
          "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000}


def duration_micros(text: str) -> int:
    """``"1 hour 30 minutes"`` in microseconds."""
    parts = text.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not a duration: {text!r}")
    total = 0
    for amount, unit in zip(parts[::2], parts[1::2]):
        total += int(amount) * _UNITS[unit.lower().rstrip("s")]
    return total


def interval(micros: int) -> Column:
    """A day-time interval literal."""
    return F.expr(f"make_dt_interval(0, 0, 0, {micros // 1_000_000}.{micros % 1_000_000:06d})")


def micros_of(col: str | Column) -> Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.unix_micros(as_col(col).cast("timestamp"))


def millis_to_instant(col: str | Column) -> Column:
    return F.timestamp_millis(as_col(col))


def in_zone(col: str | Column, zone: str) -> Column:
    """Wall clock of an instant in ``zone``."""
    return as_col(col) if zone == "UTC" else F.from_utc_timestamp(as_col(col), zone)


def format_millis(col: str | Column, pattern: str, zone: str = "UTC") -> Column:
    """Epoch milliseconds as text."""
    return F.date_format(in_zone(millis_to_instant(col), zone), pattern)


def later_at_grain(current: str | Column, history: str | Column, grain: str,
                   zone: str = "UTC") -> Column:
    """1 when ``current`` lies in a later hour, day or month than ``history``, else 0."""
    now, then = (F.date_trunc(grain, in_zone(c, zone)) for c in (current, history))
    return (now > then).cast("int")


def window_start(col: str | Column, length: str, offset: str | None = None) -> Column:
    """Start of the tumbling window that holds the time, as a plain column (no window struct)."""
    width = duration_micros(length)
    shift = duration_micros(offset) if offset else 0
    micros = micros_of(col)
    return F.timestamp_micros(micros - F.pmod(micros - shift, F.lit(width)))
