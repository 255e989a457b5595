"""The driver's tables in the engine's data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.constants import MS_PER_HOUR
from trafficcast.schemas import ATTRIBUTE, DATAPOINT
from trafficcast.sources.ingest import align


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _points(df: DataFrame, **columns: Column) -> DataFrame:
    return align(df.select(*[c.alias(name) for name, c in columns.items()]), DATAPOINT)


def event_points(spark: SparkSession, folder: str, sources: int = 4) -> DataFrame:
    """Events as hourly measurements, their users spread over the given number of sources."""
    value = F.col("value")
    return _points(
        _table(spark, folder, "events"),
        time_stamp=_millis(F.date_trunc("hour", F.col("ts").cast("timestamp"))),
        application=F.col("event_type"),
        source=F.concat(F.lit("s"), (F.col("user_id") % sources).cast("string")),
        target_address=F.col("user_id").cast("string"),
        target_attribute_id=F.col("user_id") % 25,
        app_rsp_time=value,
        byte_count=F.floor(value * 1000),
        flow_count=F.floor(value),
        rx_byte_count=F.floor(value * 600),
        rx_flow_count=F.floor(value / 2),
        tcp_rsp_time=value / 4,
        tx_byte_count=F.floor(value * 400),
        tx_flow_count=F.floor(value / 3),
    )


def event_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return align(
        _table(spark, folder, "nation").select(
            F.col("n_nationkey").alias("attribute_id"),
            F.lit(None).alias("source"),
            F.lit(None).alias("target_address"),
            F.col("n_name").alias("location"),
            F.lit(0).alias("time_stamp"),
        ),
        ATTRIBUTE,
    )


def order_points(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as hourly measurements over several years."""
    price = F.col("l_extendedprice")
    return _points(
        _table(spark, folder, "lineitem"),
        time_stamp=_millis(F.col("l_shipdate")) + F.col("l_linenumber") * F.lit(MS_PER_HOUR),
        application=F.col("l_returnflag"),
        source=F.concat(F.lit("s"), (F.col("l_suppkey") % 4).cast("string")),
        target_address=F.col("l_orderkey").cast("string"),
        target_attribute_id=F.col("l_suppkey"),
        app_rsp_time=F.col("l_discount"),
        byte_count=F.floor(price),
        flow_count=F.floor("l_quantity"),
        rx_byte_count=F.floor(price / 2),
        rx_flow_count=F.col("l_linenumber"),
        tcp_rsp_time=F.col("l_tax"),
        tx_byte_count=F.floor(price / 4),
        tx_flow_count=F.floor(F.col("l_quantity") / 2),
    )


def order_attributes(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation, region = (_table(spark, folder, n) for n in ("supplier", "nation", "region"))
    placed = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return align(
        placed.select(
            F.col("s_suppkey").alias("attribute_id"),
            F.lit(None).alias("source"),
            F.lit(None).alias("target_address"),
            F.col("r_name").alias("location"),
            F.lit(0).alias("time_stamp"),
        ),
        ATTRIBUTE,
    )


# Allowlists that leave one application of each table out, so that they filter.
EVENT_APPS = ("click", "purchase", "signup", "view")
ORDER_APPS = ("A", "R")


def denied(points: DataFrame) -> DataFrame:
    """The last source of the points as a denylist."""
    return points.agg(F.max("source").alias("source"))
