"""Time-zone independent conversions between epoch seconds and
TIMESTAMP_NTZ (no session time zone is consulted)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# Epoch seconds outside [1970-01-01, 2100-01-01) are no observation times; they
# become null (and are reported by the quality checks) instead of overflowing.
EPOCH_FIRST, EPOCH_END = 0, 4102444800


def valid_epoch(seconds: Column) -> Column:
    return (seconds >= EPOCH_FIRST) & (seconds < EPOCH_END)


def epoch_to_ntz(seconds: Column) -> Column:
    return F.when(valid_epoch(seconds), F.timestamp_add("SECOND", seconds, _epoch_ntz()))


def ntz_to_epoch(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", _epoch_ntz(), ts)


def hour_floor(ts: Column) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, keeping the NTZ type."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))
