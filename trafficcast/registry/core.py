"""Registry of checkable queries: a Spark callable and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_TIME = "yyyy-MM-dd HH:mm:ss"


def present(df: DataFrame, digits: int) -> DataFrame:
    """Rounded doubles, times as text, whole numbers as long: alike in both engines."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.TimestampType, T.DateType)):
            c = F.date_format(c, _TIME)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def wrap(body: str, columns: str, digits: int) -> str:
    """The same presentation in SQL. `columns` lists name:kind with d, t, i or s."""
    shapes = {
        "d": f"round({{0}}, {digits}) + 0.0",
        "t": "strftime(CAST({0} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
        "i": "CAST({0} AS BIGINT)",
        "s": "{0}",
    }
    items = []
    for item in columns.split():
        name, kind = item.split(":")
        quoted = f'"{name}"'
        items.append(f"{shapes[kind].format(quoted)} AS {quoted}")
    return f"SELECT {', '.join(items)} FROM ({body}) AS result"


def query(name: str, sql: str | None = None, columns: str = "", digits: int = 9):
    """Registers a Spark callable, with its SQL if it has any."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: present(fn(spark, folder), digits)
        if sql is not None:
            ORACLES[name] = wrap(sql, columns, digits)
        return fn

    return register
