"""spendlane: a freight-forwarding customer-spend report on Spark DataFrames."""

from spendlane.params import ReportParams
from spendlane.plans.context import ReportContext

__all__ = ["ReportParams", "ReportContext"]
