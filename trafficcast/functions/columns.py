"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficcast.constants import BANDWIDTH_DIVISOR


def event_time(time_stamp: Column | str) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(F.col(time_stamp) if isinstance(time_stamp, str) else time_stamp)


def event_date(time_stamp: Column | str) -> Column:
    """Epoch milliseconds to a date."""
    return F.to_date(event_time(time_stamp))


def bandwidth(byte_sum: Column) -> Column:
    return byte_sum / F.lit(BANDWIDTH_DIVISOR)


def over_limit(count: Column, limit: int) -> Column:
    """1 where the count exceeds the limit, 0 elsewhere."""
    return F.when(count > limit, 1).otherwise(0)


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def ape(actual: Column, error: Column) -> Column:
    """Absolute percentage error; NULL where the actual is 0."""
    return F.abs(F.try_divide(error * 100, actual))


def minutes(seconds: Column | float) -> Column:
    value = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    return F.round(value / 60, 2)
