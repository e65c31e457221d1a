"""Grain invariants of every leg and of the report, its order, and its container
lists where a movement has several shipment rows."""

import pytest
from pyspark.sql import functions as F

from spendlane.plans import containers as C
from spendlane.plans import export_leg as X
from spendlane.plans import import_leg as I
from spendlane.plans import lines as L
from spendlane.plans import report as RP
from spendlane.plans.context import ReportContext
from spendlane.registry import WHOLE


@pytest.fixture(scope="module")
def ctx(spark, sf_dir):
    return ReportContext.from_dir(spark, sf_dir, WHOLE)


def _unique(df, keys):
    return df.count() == df.select(*keys).distinct().count()


def test_import_leg_unique_on_invoice(ctx):
    assert _unique(I.import_leg(ctx), ["invoice_number"])


def test_export_references_unique_on_movement(ctx):
    assert _unique(X.export_references(ctx), ["so_ei_file_number"])


def test_containers_unique_on_movement(ctx):
    assert _unique(C.containers(ctx), ["ei_file_number"])


def test_report_unique_on_keys_and_keeps_every_line_group(ctx):
    grouped = RP.grouped_report(ctx)
    assert _unique(grouped, RP.GROUP_KEYS)
    lines = L.invoice_lines(ctx).select(*RP.GROUP_KEYS).distinct()
    assert grouped.count() == lines.count()


def test_report_has_76_columns(ctx):
    assert len(RP.spend_report(ctx).columns) == 76


def test_fanout_rule_takes_max_when_several_house_bills(ctx):
    rep = RP.grouped_report(ctx)
    lines = L.invoice_lines(ctx).groupBy(*RP.GROUP_KEYS).agg(
        F.max("billing_amount").alias("mx"), F.sum("billing_amount").alias("sm"))
    j = rep.join(lines, RP.GROUP_KEYS)
    multi = j.filter(F.col("hb_count") > 1)
    assert multi.count() > 0
    assert multi.filter(F.col("billing_amount") != F.col("mx")).count() == 0


def test_sorted_report_is_in_order(ctx):
    """Keys ascending, nulls last, by the raw description; checked against Python."""
    keys = RP.GROUP_KEYS
    raw = RP.grouped_report(ctx).select(*keys).collect()
    last = lambda row: tuple((row[k] is None, row[k]) if row[k] is not None else (True,) for k in keys)
    want = sorted(raw, key=last)
    got = RP.spend_report_sorted(ctx).select(*keys).collect()
    clean = lambda t: None if t is None else t.replace('"', "").replace(",", " ")
    assert [tuple(clean(r[k]) if k == "billing_line_description" else r[k] for k in keys) for r in want] == [tuple(r) for r in got]
    assert any(r.billing_line_description is None for r in got)


def test_published_report(ctx):
    shown = RP.published(RP.spend_report(ctx))
    assert len(shown.columns) == 76 and shown.columns[0] == "Invoice Date Time"


def test_movements_with_several_shipment_rows_list_containers_again(ctx):
    rows = C.movement_rows(ctx)
    assert rows.where("shipment_rows > 1").count() > 0
    joined = C.ocean_movements(ctx).join(C.container_rows(ctx), "movement_id").collect()
    numbers, types = {}, {}
    for r in joined:
        numbers.setdefault(r.movement_id, []).append(r.container_number)
        types.setdefault(r.movement_id, []).append(r.container_type)
    text = lambda v: "|".join(sorted(x for x in v if x is not None)[:31]) or None
    got = {r.ei_file_number: r for r in C.containers(ctx).collect()}
    assert got.keys() == numbers.keys()
    for m, r in got.items():
        assert (r.containers, r.container_sizes) == (text(numbers[m]), text(types[m]))
        assert r.container_count == sum(x is not None for x in numbers[m])


def test_lines_without_a_reference_are_kept(spark, sf_dir):
    from spendlane.sources.views import Views

    v = Views(spark, sf_dir)
    v.customer_invoice_fact = v.customer_invoice_fact.withColumn("internal_reference", F.when(
        F.col("invoice_line_number") > 1, F.col("internal_reference")))
    c = ReportContext(v, WHOLE)
    report = RP.grouped_report(c)
    null = report.where("internal_reference IS NULL")
    assert null.count() == L.invoice_lines(c).where("internal_reference IS NULL").select(*RP.GROUP_KEYS).distinct().count() > 0
    assert null.where("hb_count <> 0 OR house_bill IS NOT NULL").count() == 0
