"""What the report moves: each row for large dimensions only, each leg once, and of a
run of named invoices their own rows only."""

import re

import pytest
from pyspark.sql import functions as F

from spendlane.plans import containers as C
from spendlane.plans import lines as L
from spendlane.plans import report as RP
from spendlane.plans.context import ReportContext
from spendlane.registry import SCOPED, SINGLE, WHOLE
from spendlane.sources.views import Views
from test_skew import nodes, rows_of


@pytest.fixture(scope="module")
def unbroadcast(spark):
    """As on large tables: no side is known to be small, and none is found to be."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield spark
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def exchanges(df):
    """Keys of the exchanges of the plan as it is first laid out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", plan))


def test_lines_move_for_large_dimensions_only(unbroadcast, sf_dir):
    moved = exchanges(L.invoice_lines(ReportContext.from_dir(unbroadcast, sf_dir, WHOLE)))
    assert {"billing_key", "billing_client_key"} <= set(moved)
    assert not {"dt_invoice_date_key", "billing_branch_key", "billing_currency_key"} & set(moved)
    # the codes come before the clients' texts
    assert moved.index("billing_client_key") < moved.index("billing_key")


def test_each_leg_is_read_once(unbroadcast, sf_dir):
    report = RP.spend_report(ReportContext.from_dir(unbroadcast, sf_dir, WHOLE))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan
    moved = exchanges(report)
    for key in ("outbound_shipper_key", "shipper_key", "outbound_consignee_key", "consignee_key", "shipment_fact_key"):
        assert moved.count(key) == (2 if key == "shipment_fact_key" else 1), key
    assert not {"branch_origin_key", "branch_dest_key", "branch_destination_key", "service_level_key"} & set(moved)
    # both legs move to their invoice together, and lie there for the lines
    assert moved.count("leg_invoice") == 1


def test_containers_move_once_for_their_ranking(unbroadcast, sf_dir):
    moved = exchanges(C.containers(ReportContext.from_dir(unbroadcast, sf_dir, WHOLE)))
    assert not [k for k in moved if "kind" in k]
    assert moved.count("movement_id") == 4  # counts, numbers, types and shipment rows


@pytest.mark.parametrize("params", [SCOPED, SINGLE], ids=["scoped", "single"])
def test_named_invoices_move_their_own_rows(unbroadcast, sf_dir, params):
    df = RP.spend_report(ReportContext.from_dir(unbroadcast, sf_dir, params))
    df.collect()
    moved = [(re.sub(r"#\d+L?", "", x.simpleString(60)), x.metrics().get("shuffleRecordsWritten").get().value())
             for x in nodes(df._jdf.queryExecution().executedPlan()) if x.nodeName() == "Exchange"]
    keys = ("movement_id", "shipment_fact_key", "invoice_no", "leg_invoice", "house_bill", "shipper_key", "consignee_key")
    facts = [(k, n) for k, n in moved if any(f"({key}" in k for key in keys)]
    assert len(facts) > 5
    assert max(n for _, n in facts) <= 50, facts


def test_named_invoices_give_the_rows_of_the_whole_report(spark, sf_dir):
    """A movement's containers and references do not depend on how the run is restricted."""
    views = Views(spark, sf_dir)
    ctx = ReportContext(views, WHOLE)
    whole = RP.spend_report(ctx)
    lines = [r[0] for r in L.invoice_lines(ctx).groupBy("invoice_expeditor").agg(F.min("internal_reference").alias("r"))
             .where("r IS NOT NULL").orderBy("invoice_expeditor").limit(400).collect()][::8]
    refs = [r[0] for r in L.invoice_lines(ctx).where(F.col("invoice_expeditor").isin(*lines))
            .select("internal_reference").distinct().collect()]
    from spendlane.params import ReportParams

    some = RP.spend_report(ReportContext(views, ReportParams(
        invoice_numbers=(*lines, *[r for r in refs if r]), scope_export_references=False)))
    want = whole.where(F.col("invoice_expeditor").isin(*lines))
    assert rows_of(some, RP.REPORT_COLUMNS) == rows_of(want, RP.REPORT_COLUMNS)
