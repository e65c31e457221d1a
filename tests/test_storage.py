"""Stored layouts and scopes given as tables: what reaches the scans, and that rows stay the same."""

import contextlib
import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spendlane.params import ReportParams
from spendlane.plans import export_leg as X
from spendlane.plans import import_leg as I
from spendlane.plans import lines as L
from spendlane.plans import report as RP
from spendlane.plans.context import ReportContext
from spendlane.registry import DATE_SCOPE, GCI_SCOPE, MASTER_SCOPE, SCOPED, WHOLE
from spendlane.sources.named import save_bucketed, write_views
from spendlane.sources.views import Views


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def same(a, b):
    assert a.columns == b.columns
    rows = Counter(tuple(r) for r in a.collect())
    assert rows and rows == Counter(tuple(r) for r in b.collect())


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    return write_views(Views(spark, sf_dir), str(tmp_path_factory.mktemp("views") / "v"), by_month=True)


def test_date_scope_reads_its_months_only(spark, sf_dir, stored):
    p = ReportParams(start=dt.date(1996, 1, 5), end=dt.date(1996, 3, 20))
    lines = L.invoice_lines(ReportContext(stored, p))
    scans = [x for x in executed(lines).splitlines() if "FileScan" in x and "billing_amount#" in x]
    assert len(scans) == 1 and "dynamicpruning" in scans[0] and "PartitionFilters: [isnotnull(invoice_month" in scans[0]
    plan = lines._jdf.queryExecution().executedPlan()
    read = [n for n in _nodes(plan) if "customer_invoice_fact" in n.verboseStringWithOperatorId()]
    assert any(n.metrics().get("numPartitions").get().value() == 3 for n in read if n.metrics().contains("numPartitions"))
    for p in (p, DATE_SCOPE, WHOLE):
        same(L.invoice_lines(ReportContext(stored, p)), L.invoice_lines(ReportContext.from_dir(spark, sf_dir, p)))


def _nodes(plan):
    out, todo = [], [plan]
    while todo:
        n = todo.pop()
        out.append(n)
        if n.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(n.executedPlan())
        elif "QueryStage" in n.nodeName():
            todo.append(n.plan())
        todo += [n.children().apply(i) for i in range(n.children().size())]
    return out


def test_lines_of_unknown_dates_are_stored(spark, sf_dir, tmp_path):
    v = Views(spark, sf_dir)
    v.customer_invoice_fact = v.customer_invoice_fact.withColumn("dt_invoice_date_key", F.when(
        F.col("invoice_line_number") > 1, F.col("dt_invoice_date_key")))
    s = write_views(v, str(tmp_path / "v"), by_month=True)
    assert s.customer_invoice_fact.count() == v.customer_invoice_fact.count()
    same(L.invoice_lines(ReportContext(s, WHOLE)), L.invoice_lines(ReportContext(v, WHOLE)))


def ids(spark, tmp_path, values, name):
    spark.createDataFrame([(v,) for v in values], "id string").write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


@pytest.mark.parametrize("p", (GCI_SCOPE, MASTER_SCOPE))
def test_client_table_gives_the_rows_of_the_list(spark, sf_dir, tmp_path, p):
    """100,000 ids, repeated and null ones too; the runtime filter reaches the fact."""
    import dataclasses

    values = [*p.client_ids, *p.client_ids, None, *(f"Z{i}" for i in range(100_000))]
    table = ids(spark, tmp_path, values, "clients")
    open_ = dataclasses.replace(p, client_ids=None)
    for part in (L.invoice_lines, I.import_leg, X.export_references):
        same(part(ReportContext(Views(spark, sf_dir), open_, clients=table)), part(ReportContext.from_dir(spark, sf_dir, p)))


def test_client_table_prunes_the_scan_of_the_fact(spark, stored, tmp_path):
    table = ids(spark, tmp_path, ["G11", *(f"Z{i}" for i in range(100_000))], "clients")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
                  spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold=0):
        plan = executed(L.invoice_lines(ReportContext(stored, ReportParams(client_type="GCI"), clients=table)))
    assert re.search(r"Filter .*might_contain\(.*billing_client_key", plan)


def test_invoice_table_gives_the_rows_of_the_list(spark, sf_dir, tmp_path):
    import dataclasses

    table = ids(spark, tmp_path, [*SCOPED.invoice_numbers, None, *(f"Z{i}" for i in range(100_000))], "invoices")
    open_ = dataclasses.replace(SCOPED, invoice_numbers=None)
    same(RP.spend_report(ReportContext(Views(spark, sf_dir), open_, invoices=table)),
         RP.spend_report(ReportContext.from_dir(spark, sf_dir, SCOPED)))


def test_a_scope_is_given_once(spark, sf_dir):
    table = spark.createDataFrame([("x",)], "id string")
    for p, kind in ((MASTER_SCOPE, "clients"), (SCOPED, "invoices")):
        with pytest.raises(ValueError, match=kind):
            ReportContext(Views(spark, sf_dir), p, **{kind: table})


def test_legs_do_not_move_bucketed_facts(spark, sf_dir):
    """Shipments, references and events of the import leg meet without an exchange;
    the export side moves rows only where it goes from movements to invoices."""
    views = save_bucketed(Views(spark, sf_dir), "spendlane_test_", 4)
    try:
        ctx = ReportContext(views, WHOLE)
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=100_000, spark__sql__adaptive__autoBroadcastJoinThreshold=-1):
            plan = executed(I.import_leg(ctx))
            assert "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") >= 3
            shipped = executed(X.scoped_movement_invoices(ctx).join(X.scoped_shipments(ctx).select("movement_id"), "movement_id"))
            assert "Exchange hashpartitioning" not in shipped
        derived = ReportContext.from_dir(spark, sf_dir, WHOLE)
        for leg in (I.import_leg, X.export_leg):
            same(leg(ctx), leg(derived))
    finally:
        for name in views.names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_stacked_roles_give_the_rows_of_the_joins(spark, sf_dir, stored):
    """Parties that the dimension does not know drop the shipment in both forms; the
    clients are scanned once and shuffled once."""
    p = ReportParams(stacked_roles=("party_clients", "branches", "ports"))
    v = Views(spark, sf_dir)
    v.client_dimension = v.client_dimension.where("client_key % 5 <> 2")
    for leg in (I.import_leg, X.export_leg_base):
        same(leg(ReportContext(v, p)), leg(ReportContext(v, WHOLE)))
    one = ReportParams(stacked_roles=("party_clients",))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1):
        for leg, roles in ((I.import_shipments, I.ROLES), (X.export_leg_base, X.ROLES)):
            plan = executed(leg(ReportContext(stored, one)))
            scans = [x for x in plan.splitlines() if "FileScan" in x and "gci_addr_line1#" in x]
            assert len(scans) == 1 and "ReusedExchange [found_key" not in plan
            assert plan.count("Exchange hashpartitioning(found_key#") == 1, roles
    with pytest.raises(ValueError, match="roles"):
        ReportParams(stacked_roles=("clients",))
