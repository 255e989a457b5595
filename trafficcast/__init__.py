"""Network-traffic series, forecasting and evaluation as Spark DataFrames."""

from trafficcast.plans.reports import REPORTS, report
from trafficcast.session import build_session, shared_dir

__all__ = ["REPORTS", "build_session", "report", "shared_dir"]
