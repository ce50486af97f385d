"""Durations and event-time helpers."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, functions as F

_UNITS = {"ms": 0.001, "millisecond": 0.001, "milliseconds": 0.001,
          "s": 1, "sec": 1, "second": 1, "seconds": 1,
          "m": 60, "min": 60, "minute": 60, "minutes": 60,
          "h": 3600, "hour": 3600, "hours": 3600,
          "d": 86400, "day": 86400, "days": 86400}


def seconds_of(d) -> float:
    """'10 minutes' / 600 / timedelta -> seconds."""
    if isinstance(d, _dt.timedelta):
        return d.total_seconds()
    if isinstance(d, (int, float)):
        return float(d)
    m = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*", str(d))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad duration: {d!r}")
    return float(m.group(1)) * _UNITS[m.group(2).lower()]


def micros_of(d) -> int:
    """A duration in whole microseconds; finer ones are refused."""
    us = seconds_of(d) * 1_000_000
    if abs(us - round(us)) > 1e-3:
        raise ValueError(f"finer than a microsecond: {d!r}")
    return int(round(us))


def positive_micros(d) -> int:
    us = micros_of(d)
    if us <= 0:
        raise ValueError(f"not a positive duration: {d!r}")
    return us


def window_text(d) -> str:
    """A positive duration as ``F.window`` takes it, exact to the microsecond."""
    return f"{positive_micros(d)} microseconds"


def interval(d) -> Column:
    """A day-time interval literal for ``d``; microsecond exact."""
    # A literal (not an expression): stream-stream joins read their state
    # bounds from literal intervals in the join condition.
    micros = micros_of(d)
    sign = "-" if micros < 0 else ""
    days, rem = divmod(abs(micros), 86_400_000_000)
    hours, rem = divmod(rem, 3_600_000_000)
    mins, rem = divmod(rem, 60_000_000)
    secs, us = divmod(rem, 1_000_000)
    return F.expr(f"INTERVAL '{sign}{days} {hours:02d}:{mins:02d}:{secs:02d}.{us:06d}' DAY TO SECOND")


EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _ntz_micros(expr: str) -> str:
    # a difference of two TIMESTAMP_NTZ never passes through the session zone
    return f"CAST(CAST(CAST(({expr}) - {EPOCH_NTZ} AS INTERVAL SECOND) AS DECIMAL(20, 6)) * 1000000 AS BIGINT)"


def to_event_ts(df, col: str) -> Column:
    """A TIMESTAMP for ``withWatermark``; NTZ is read as UTC wall clock,
    whatever the session zone."""
    return F.timestamp_micros(epoch_micros(df, col))


def utc_ntz(micros: Column) -> Column:
    """Microseconds since the epoch as UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH_NTZ))


def epoch_micros(df, col: str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP or TIMESTAMP_NTZ column,
    independent of the session time zone (NTZ is read as UTC wall time)."""
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.expr(_ntz_micros(f"`{col}`"))
    return F.unix_micros(F.col(col))


def micros_between(df, first: str, last: str) -> Column:
    """Microseconds from ``first`` to ``last`` (both of one type), in any zone."""
    return epoch_micros(df, last) - epoch_micros(df, first)
