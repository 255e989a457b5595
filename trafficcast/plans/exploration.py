"""What an analyst looks at before modelling a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.operators.explore import correlations, hour_means, summary
from trafficcast.operators.filters import nonzero
from trafficcast.operators.series import daily_peak


def select_series(df: DataFrame, **key: str) -> DataFrame:
    """Rows of one key; the equalities reach the scan."""
    for column, value in key.items():
        df = df.filter(F.col(column) == value)
    return df


def explore(
    points: DataFrame, value: str, measures: Sequence[str], **key: str
) -> dict[str, DataFrame]:
    """Correlations of rows and of hour means, summary of the hours and their daily peak."""
    rows = nonzero(select_series(points, **key), value)
    hours = hour_means(rows, measures, list(key))
    return {
        "rows": correlations(rows, measures),
        "hours": correlations(hours, measures),
        "summary": summary(hours, list(key), [value]),
        "daily": daily_peak(hours, list(key), [value]),
    }
