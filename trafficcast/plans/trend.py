"""The result tables from the native trend model instead of the additive one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.operators.evaluate import error_metrics, pair, with_errors
from trafficcast.operators.forecast import HORIZONS, model_frame, trend_forecast
from trafficcast.plans.reports import ReportSpec, as_series


def trend_tables(
    data: DataFrame,
    spec: ReportSpec,
    horizon: str,
    run_date: dt.date,
    outlier: str | None = None,
) -> dict[str, DataFrame]:
    """forecast, valid and analyse of a data table; `outlier` overrides the report's rule."""
    grain, keys = HORIZONS[horizon], list(spec.keys)
    frame = model_frame(
        as_series(data, spec), keys, grain, outlier or spec.outlier, spec.min_usable
    )
    test = F.col("is_test")
    ahead = trend_forecast(frame, keys, "y_full", grain)
    held = trend_forecast(frame.filter(~test), keys, "y_train", grain)
    pairs = with_errors(
        pair(frame.filter(test).select(*keys, "ds", "y", "length"), held, keys)
    )
    scores = error_metrics(pairs, keys, carry=["length"])
    return {
        "forecast": ahead.withColumn("run_date", F.lit(run_date)),
        "valid": pairs.drop("length"),
        "analyse": scores.withColumn("run_date", F.lit(run_date)),
    }
