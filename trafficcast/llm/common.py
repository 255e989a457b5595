"""What the operators share: input columns, staged tables, schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficcast.session import discard, settled, staged

__all__ = ["arrow_map", "discard", "documents", "keyed", "settled", "staged"]


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed(df: DataFrame, key: str, text: str | None = None) -> DataFrame:
    """Only the key and the text, under fixed names, so that no other column can clash."""
    columns = [df[key].alias("key")]
    if text is not None:
        columns.append(F.coalesce(df[text].cast("string"), F.lit("")).alias("text"))
    return df.select(*columns)


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], key: str, columns: str
) -> DataFrame:
    """mapInArrow whose output starts with the key column of `df`, named `key`."""
    fields = [T.StructField(key, df.schema["key"].dataType)]
    schema = T.StructType(fields + T.StructType.fromDDL(columns).fields)
    return df.mapInArrow(fn, schema)
