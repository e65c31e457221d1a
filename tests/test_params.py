"""Scopes: what is not given restricts nothing."""

import datetime as dt

import pytest

from spendlane.operators.scope import client_scope, date_scope
from spendlane.params import ReportParams


def test_no_scope_keeps_every_date_and_client(spark):
    clients = spark.createDataFrame([("M1", "G1"), (None, "G2")], "master_client_number string, gci string")
    days = spark.createDataFrame([(dt.date(1850, 1, 1),), (dt.date(3500, 1, 1),), (None,)], "day date")
    p = ReportParams()
    assert client_scope(clients, p).count() == 2 and date_scope(days, "day", p).count() == 3


def test_each_end_of_the_date_range_is_its_own(spark):
    days = spark.createDataFrame([(dt.date(y, 1, 1),) for y in (1850, 1990, 2010)], "day date")
    assert date_scope(days, "day", ReportParams(start=dt.date(1990, 1, 1))).count() == 2
    assert date_scope(days, "day", ReportParams(end=dt.date(1990, 1, 1))).count() == 2


def test_empty_scopes_are_errors():
    for name in ("client_ids", "invoice_numbers"):
        with pytest.raises(ValueError, match=name):
            ReportParams(**{name: ()})
    with pytest.raises(ValueError, match="variant"):
        ReportParams(variant="other")


def test_whole_report_keeps_a_line_without_master_number_from_1850(spark, sf_dir):
    """A client with no master number and a date before every other survive."""
    from pyspark.sql import functions as F

    from spendlane.plans.context import ReportContext
    from spendlane.plans.lines import invoice_lines
    from spendlane.sources.views import Views

    v = Views(spark, sf_dir)
    early = dt.datetime(1850, 3, 4)
    first = v.customer_invoice_fact.orderBy("invoice_number", "invoice_line_number").first()
    v.customer_invoice_fact = v.customer_invoice_fact.withColumn("dt_invoice_date_key", F.when(
        F.col("invoice_number") == first.invoice_number, 18500304).otherwise(F.col("dt_invoice_date_key")))
    days = v.date_dimension
    v.date_dimension = days.unionByName(spark.createDataFrame([(18500304, early.date(), 1850, "March")], days.schema))
    v.client_dimension = v.client_dimension.withColumn("master_client_number", F.when(
        F.col("client_key") != first.billing_client_key, F.col("master_client_number")))
    lines = invoice_lines(ReportContext(v, ReportParams())).where(F.col("invoice_expeditor") == first.invoice_number)
    row = lines.first()
    assert row.invoice_date == early.date() and row.billing_master_client_number is None
