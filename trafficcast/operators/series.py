"""Hourly and daily series of each report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficcast.constants import FEATURE_MEASURES, HOURLY_TAIL, POINT_LIMIT
from trafficcast.functions.columns import bandwidth, event_date, event_time, over_limit, weekday
from trafficcast.operators.filters import drop_denied, nonzero

#: A dimension is broadcast up to so many bytes, which are counted first.
BROADCAST_BYTES = 8 << 20
#: Parts that the rows of one attribute id are dealt to where its dimension is too large to broadcast.
_SALTS = 16


# -- dimension ---------------------------------------------------------------


def locations(attrs: DataFrame, dedupe_latest: bool = False) -> DataFrame:
    """Location per attribute id, with the number of times the pair occurs.

    Joining the pairs and weighting by `copies` gives what joining the raw
    dimension would, without repeating fact rows.
    """
    if dedupe_latest:
        attrs = attrs.groupBy("attribute_id").agg(
            F.max_by("location", "time_stamp").alias("location")
        )
    return attrs.groupBy(F.col("attribute_id").alias("target_attribute_id"), "location").agg(
        F.count(F.lit(1)).alias("copies")
    )


def fits(places: DataFrame) -> bool:
    """Whether a dimension may be broadcast: an aggregation over it adds up what it would weigh."""
    weight = F.lit(32) + F.coalesce(F.octet_length("location"), F.lit(0))
    return (places.agg(F.sum(weight).alias("bytes")).first()["bytes"] or 0) <= BROADCAST_BYTES


def with_locations(rows: DataFrame, places: DataFrame, broadcast: bool) -> DataFrame:
    """Rows with the locations of their attribute id, or without one.

    Broadcast, the rows stay where they are. Otherwise a NULL id, which matches
    nothing, takes no part in the join, and the rows of every other id are dealt
    to several parts, for each of which the dimension repeats.
    """
    if broadcast:
        return rows.join(F.broadcast(places), "target_attribute_id", "left")
    known = rows.filter(F.col("target_attribute_id").isNotNull())
    salt = F.pmod(F.xxhash64("time_stamp", *[c for c in ("target_address",) if c in rows.columns]), F.lit(_SALTS))
    salted = places.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    joined = known.withColumn("_salt", salt).join(salted, ["target_attribute_id", "_salt"], "left").drop("_salt")
    unknown = rows.filter(F.col("target_attribute_id").isNull())
    return joined.unionByName(unknown, allowMissingColumns=True)


# -- hourly aggregates -------------------------------------------------------


def hourly_rsp_time(points: DataFrame) -> DataFrame:
    mean = points.groupBy("source", "application", "time_stamp").agg(
        F.avg("app_rsp_time").alias("app_rsp_time")
    )
    return nonzero(mean, "app_rsp_time")


def hourly_app_count(points: DataFrame) -> DataFrame:
    return points.groupBy("source", "time_stamp").agg(
        F.count_distinct("application").alias("app_count")
    )


def hourly_users(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct targets; Spark removes duplicates on (keys, hour, target) before counting."""
    return points.groupBy(*keys, "time_stamp").agg(
        F.count_distinct("target_address").alias("user_count")
    )


def hourly_users_location(points: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct targets per location; where the join shuffles, only distinct rows go through it."""
    seen, broadcast = points.select("target_attribute_id", "target_address", "time_stamp"), fits(places)
    if not broadcast:
        seen = seen.distinct()
    return hourly_users(with_locations(seen, places, broadcast), ["location"])


def hourly_bytes(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    total = points.groupBy(*keys, "time_stamp").agg(F.sum("byte_count").alias("byte_count_sum"))
    return nonzero(total, "byte_count_sum")


def hourly_bytes_location(points: DataFrame, places: DataFrame) -> DataFrame:
    """Byte sums per location; where the join shuffles, sums per attribute id go through it."""
    rows, broadcast = points.select("target_attribute_id", "time_stamp", F.col("byte_count").alias("_bytes")), fits(places)
    if not broadcast:
        rows = rows.groupBy("target_attribute_id", "time_stamp").agg(F.sum("_bytes").alias("_bytes"))
    total = (
        with_locations(rows, places, broadcast)
        .groupBy("location", "time_stamp")
        .agg(F.sum(F.col("_bytes") * F.coalesce("copies", F.lit(1))).alias("byte_count_sum"))
    )
    return nonzero(total, "byte_count_sum")


def roll_up_bytes(hourly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coarser byte sums from finer ones: sums roll up, distinct counts do not."""
    total = hourly.groupBy(*keys, "time_stamp").agg(
        F.sum("byte_count_sum").alias("byte_count_sum")
    )
    return nonzero(total, "byte_count_sum")


def with_bandwidth(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("bw", bandwidth(F.col("byte_count_sum")))


def hourly_measures(
    points: DataFrame, keys: Sequence[str], measures: Sequence[str] = FEATURE_MEASURES
) -> DataFrame:
    """Mean of every measure; hours with a zero or missing first measure go."""
    means = points.groupBy(*keys, "time_stamp").agg(*[F.avg(m).alias(m) for m in measures])
    return nonzero(means, measures[0])


# -- model grain -------------------------------------------------------------


def placed(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows placed by series, for all that follows per series.

    The count is fixed on purpose: series are small but their fits are not, and
    a count by size would leave thousands of fits to one task. Placing rows that
    already are in place costs nothing.
    """
    spark = series.sparkSession
    n = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    return series.repartition(n, *keys)


def daily_peak(hourly: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Highest hour of each day.

    The hourly rows are placed by series once; grouping by day and every later
    step per series find them in place.
    """
    return (
        placed(hourly, keys)
        .groupBy(*keys, event_date("time_stamp").alias("date"))
        .agg(*[F.max(v).alias(v) for v in values])
    )


def daily_peak_measures(
    hourly: DataFrame, keys: Sequence[str], measures: Sequence[str] = FEATURE_MEASURES
) -> DataFrame:
    """Daily peak of all measures and of the weekday."""
    tagged = hourly.withColumn("weekday", weekday(event_time("time_stamp")))
    return daily_peak(tagged, keys, [*measures, "weekday"])


def hourly_peak(hourly: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Peak per identical hour."""
    return (
        placed(hourly, keys)
        .groupBy(*keys, "time_stamp")
        .agg(*[F.max(v).alias(v) for v in values])
    )


def last_points(
    series: DataFrame, keys: Sequence[str], order: str, n: int = HOURLY_TAIL
) -> DataFrame:
    """Last n points of each series; Spark keeps n rows per key before it sorts the rest."""
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return (
        series.withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= n)
        .drop("_rn")
    )


def eligible(
    hourly: DataFrame,
    keys: Sequence[str],
    denylist: DataFrame | None = None,
    denied_on: str = "source",
    limit: int = POINT_LIMIT,
) -> DataFrame:
    """Combinations with more than `limit` hours that are not denied."""
    counts = hourly.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    kept = counts.withColumn("count_flag", over_limit(F.col("count"), limit)).filter(
        F.col("count_flag") == 1
    )
    return kept if denylist is None else drop_denied(kept, denylist, denied_on)


def series_keys(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    return series.select(*keys).distinct()
