"""One pre-aggregate of the measurements, from which every report's hourly series rolls up.

A row of the grain is an (application, source, attribute id, target, hour) with the sums and counts
that the reports need. Sums add up to sums and means; distinct applications and targets are those of
the rows, as no key of a report is finer than the grain. A night thus reads the measurements once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.operators.filters import nonzero

GRAIN_KEYS = ("application", "source", "target_attribute_id", "target_address", "time_stamp")


def base_grain(points: DataFrame) -> DataFrame:
    """Sums per grain key, combined within tasks before the one shuffle.

    rsp_sum and rsp_count make means; bytes holds all bytes; clean_rows and clean_bytes are of the
    measurements that have both a response time and bytes.
    """
    clean = (F.col("app_rsp_time") != 0) & (F.col("byte_count") != 0)
    return points.groupBy(*GRAIN_KEYS).agg(
        F.sum("app_rsp_time").alias("rsp_sum"),
        F.count("app_rsp_time").alias("rsp_count"),
        F.sum("byte_count").alias("bytes"),
        F.count(F.when(clean, 1)).alias("clean_rows"),
        F.sum(F.when(clean, F.col("byte_count"))).alias("clean_bytes"),
    )


def grain_rows(grain: DataFrame, clean: bool) -> DataFrame:
    """The grain as a report's aggregates take it: byte_count is the sum of the rows the report uses."""
    if clean:
        return grain.filter(F.col("clean_rows") > 0).withColumn("byte_count", F.col("clean_bytes"))
    return grain.withColumn("byte_count", F.col("bytes"))


def hourly_rsp_time_of(grain: DataFrame, keys: Sequence[str] = ("source", "application")) -> DataFrame:
    """Mean response time per hour from sums and counts; hours without one, or with mean zero, go."""
    mean = grain.groupBy(*keys, "time_stamp").agg((F.sum("rsp_sum") / F.nullif(F.sum("rsp_count"), F.lit(0))).alias("app_rsp_time"))
    return nonzero(mean, "app_rsp_time")
