"""Session defaults and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from trafficcast.sources.files import drop_folder

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_shipped: set[str] = set()
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: Paths staged while a call of `settled` runs.
_inner: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("inner", default=None)


def build_session(master: str | None = None, app_name: str = "trafficcast", **conf) -> SparkSession:
    """A session with the engine's defaults; master and resources stay the caller's choice."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent
        folder = tempfile.mkdtemp(prefix="trafficcast-package-")
        archive = shutil.make_archive(f"{folder}/trafficcast", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors can reach.

    It is what spark.checkpoint.dir names, or else a folder below the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, one per use."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, so that no later step recomputes it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (noted := _inner.get()) is not None:
        noted.append((spark, path))
    df.write.parquet(path)
    table = spark.read.parquet(path)
    _paths[table] = path
    return table


def discard(table: DataFrame) -> None:
    """Drops a staged table that nothing will read any more."""
    drop_folder(table.sparkSession, _paths[table])


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `make` gives, staged; the tables it staged on its way are dropped, also if it fails."""
    noted: list[tuple[SparkSession, str]] = []
    token = _inner.set(noted)
    try:
        df = make()
        _inner.reset(token)
        token = None
        return staged(df, name)
    finally:
        if token:
            _inner.reset(token)
        for spark, path in noted:
            drop_folder(spark, path)
