"""Incremental append as a stream over a landing folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trafficcast.sources.ingest import land, retain, settle


def follow(
    spark: SparkSession,
    landing: str,
    store: str,
    schema: T.StructType,
    checkpoint: str,
    fmt: str = "parquet",
    trim: bool = False,
) -> StreamingQuery:
    """Appends what has landed since the last call, then ends.

    Every landed row is added, also one of an hour or day that is stored already: the checkpoint, not
    the stored mark, knows what is new. Batches land under their own number, so that one repeated after
    a failure replaces what it had added. With `trim`, each batch is followed by the
    retention of the nightly append; without it the store keeps everything.
    """

    def append(batch: DataFrame, number: int) -> None:
        # The stream's own id: another stream, or a new checkpoint in the old place, counts from 0 again.
        stream = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]
        land(batch, schema, store, f"{stream}-{number}")
        settle(spark, store, schema)
        if trim:
            retain(spark, store, schema)

    landed = spark.readStream.format(fmt).schema(schema).load(landing)
    return (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
