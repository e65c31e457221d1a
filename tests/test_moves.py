"""What the report's lines and legs move: lines are summed up where they lie, import rows
stay by their invoice, and the sorted report's line groups travel to their order in packs."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendlane.plans import lines as L
from spendlane.plans import report as RP
from spendlane.plans.containers import CONTAINER_COLUMNS, containers
from spendlane.plans.context import ReportContext
from spendlane.plans.import_leg import import_leg, import_leg_with_containers
from spendlane.registry import QUERIES, WHOLE
from spendlane.session import SPLIT_ALWAYS
from spendlane.sources.views import Views
from test_skew import nodes, rows_of
from test_volume import exchanges, unbroadcast  # noqa: F401


def set_conf(spark, values):
    before = {n: spark.conf.get(n, None) for n in values}
    for n, v in values.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    return before


def executed_exchanges(df):
    """The first words of each exchange of the executed plan, and the rows it wrote."""
    df.collect()
    return [(re.sub(r"#\d+L?", "", x.simpleString(200)), x.metrics().get("shuffleRecordsWritten").get().value())
            for x in nodes(df._jdf.queryExecution().executedPlan()) if x.nodeName() == "Exchange"]


def test_lines_are_summed_up_where_they_lie(unbroadcast, sf_dir):  # noqa: F811
    moved = exchanges(RP.spend_report(ReportContext.from_dir(unbroadcast, sf_dir, WHOLE)))
    assert moved.count("line_reference") == 1
    assert not [k for k in moved if "invoice_expeditor_line" in k or "invoice_line_number" in k]


def test_import_rows_stay_by_their_invoice(unbroadcast, sf_dir):  # noqa: F811
    report = RP.spend_report(ReportContext.from_dir(unbroadcast, sf_dir, WHOLE))
    moved = exchanges(report)
    assert "house_bill" not in moved
    # shipments meet their containers while narrow, before their parties' texts
    assert moved.count("housebill_ref") == 1 and moved.index("shipper_key") < moved.index("housebill_ref")


def test_sorted_report_travels_in_packs(unbroadcast, sf_dir):  # noqa: F811
    ctx = ReportContext.from_dir(unbroadcast, sf_dir, WHOLE)
    df = RP.spend_report_sorted(ctx)
    ranged = [n for text, n in executed_exchanges(df) if "rangepartitioning" in text]
    groups = df.count()
    assert len(ranged) == 1 and 0 < ranged[0] < groups / 2


def test_packs_are_bounded_and_keep_every_group(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(RP, "PACK", 3)
    monkeypatch.setattr(RP, "PACKED_LINES", 2)
    ctx = ReportContext.from_dir(spark, sf_dir, WHOLE)
    assert RP._packed(L.lines_per_group(ctx)).agg(F.max(F.size("_groups"))).first()[0] <= 3
    got = RP.spend_report_sorted(ctx).collect()
    keys = [tuple((r[k] is None, r[k]) for k in ("invoice_date_time", "invoice_expeditor", "invoice_expeditor_line")) for r in got]
    assert keys == sorted(keys)
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(tuple(r)) for r in RP.spend_report(ctx).collect())


def test_invoices_with_several_house_bills_list_those_of_the_greatest(spark, sf_dir):
    v = Views(spark, sf_dir)
    imports = v.import_shipment_fact
    more = imports.withColumn("housebill_ref", F.when(F.pmod(F.xxhash64("invoice_number"), F.lit(2)) == 0, F.lit("A")))
    v.import_shipment_fact = imports.unionByName(more).unionByName(more.withColumn("housebill_ref", F.lit(None).cast("string")))
    ctx = ReportContext(v, WHOLE)
    lists = containers(ctx).select(F.col("ei_file_number").alias("bill"), *CONTAINER_COLUMNS)
    leg = import_leg(ctx)
    want = leg.join(lists, leg.ei_file_number == lists.bill, "left").drop("bill")
    got = import_leg_with_containers(ctx)
    assert want.where("containers IS NOT NULL").count() > 0
    assert rows_of(got, want.columns) == rows_of(want, want.columns)


def test_amounts_travel_without_what_they_do_not_show(unbroadcast, sf_dir):  # noqa: F811
    df = QUERIES["fanout_safe_amount"].build(unbroadcast, sf_dir)
    moved = exchanges(df)
    assert moved.count("line_reference") == 1
    assert "housebill_ref" not in moved
    # what goes to the clients no longer holds the keys of the small dimensions
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(billing_client_key" in line)
    assert "Project" in plan[at + 1] and "billing_code" in plan[at + 1]
    assert not [k for k in ("billing_currency_key", "billing_branch_key", "dt_revenue_month_key") if k in plan[at + 1]]


def odd_lines(spark, sf_dir):
    """Lines of one group that differ in client, branch, currency, month and type, rates
    that are negative or null, amounts below zero, keys that are null."""
    v = Views(spark, sf_dir)
    fact = v.customer_invoice_fact
    h = F.pmod(F.xxhash64("invoice_number", "invoice_line_number"), F.lit(5))
    one = fact.agg(*[F.min(c).alias(c) for c in ("dt_invoice_date", "dt_invoice_date_key", "billing_key")]).first()
    same = fact.where(h == 0)
    for c, x in one.asDict().items():
        same = same.withColumn(c, F.lit(x).cast(fact.schema[c].dataType))
    same = same.withColumn("invoice_number", F.lit("E1")).withColumn("invoice_line_number", F.pmod(F.col("billing_client_key"), F.lit(3)).cast("int"))
    same = same.withColumn("internal_reference", F.when(F.col("invoice_line_number") > 0, F.min("internal_reference").over(
        Window.partitionBy("invoice_line_number")))).withColumn("billing_line_description", F.lit('a "b", c'))
    rest = fact.where(h > 0).withColumn("invoice_line_number", F.when(h > 1, F.col("invoice_line_number"))).withColumn(
        "invoice_number", F.when(h != 2, F.col("invoice_number")))
    amount = F.when(F.pmod(F.xxhash64("billing_amount"), F.lit(3)) > 0, F.col("billing_amount")).otherwise(-F.col("billing_amount"))
    v.customer_invoice_fact = same.select(*fact.columns).unionByName(rest).withColumn("billing_amount", amount.cast("decimal(18,2)"))
    r = F.col("average_exchange_rate")
    v.currency_exchange_dimension = v.currency_exchange_dimension.withColumn(
        "average_exchange_rate", F.when(F.col("currency_key") == 1, -r).when(F.col("currency_key") != 3, r).cast("decimal(9,4)"))
    return ReportContext(v, WHOLE)


def test_groups_of_several_clients_and_rates(spark, sf_dir):
    ctx = odd_lines(spark, sf_dir)
    got = L.lines_per_group(ctx)
    want = L.invoice_lines(ctx).groupBy(*L.GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("q_rows"),
        F.sum("billing_amount").cast(RP.AMOUNT).alias("q_sum_amount"), F.max("billing_amount").alias("q_max_amount"),
        F.sum("billing_amount_usd").alias("q_sum_amount_usd"), F.max("billing_amount_usd").alias("q_max_amount_usd"),
        F.avg("usd_average_exchange_rate").cast(L.RATE).alias("usd_average_exchange_rate"),
        *[F.max(c).alias(c) for c in L.LINE_MAXED])
    assert want.agg(F.max("q_rows")).first()[0] > 5
    assert want.where("q_max_amount_usd < 0").count() > 0 and want.where("q_sum_amount_usd IS NULL").count() > 0
    assert rows_of(got, want.columns) == rows_of(want, want.columns)


def test_a_subset_of_the_report_is_its_columns(spark, sf_dir):
    ctx = odd_lines(spark, sf_dir)
    cols = ("bill_to_customer_flag", "destination_country", "hb_count")
    some = RP.spend_report(ctx, cols)
    assert set(some.columns) == {*RP.GROUP_KEYS, *cols}
    assert rows_of(some, some.columns) == rows_of(RP.spend_report(ctx), some.columns)


@pytest.fixture
def splitting(unbroadcast):  # noqa: F811
    """Partitions of some kB count as skewed."""
    before = set_conf(unbroadcast, {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", SPLIT_ALWAYS: "true"})
    yield unbroadcast
    set_conf(unbroadcast, before)


def test_a_client_with_most_lines_is_split(splitting, sf_dir):
    """Lines of a skewed client are read by several tasks, and then summed up by a shuffle
    that they reach combined."""
    v = Views(splitting, sf_dir)
    fact = v.customer_invoice_fact
    one = fact.agg(F.min("billing_client_key")).first()[0]
    v.customer_invoice_fact = fact.withColumn("billing_client_key", F.when(
        F.col("invoice_line_number") > 1, F.lit(one)).otherwise(F.col("billing_client_key")))
    ctx = ReportContext(v, WHOLE)
    df = L.lines_per_group(ctx)
    moved = executed_exchanges(df)
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "skew=true" in plan
    assert [n for text, n in moved if "invoice_expeditor_line" in text]
    want = L.invoice_lines(ctx).groupBy(*L.GROUP_KEYS).agg(F.count(F.lit(1)).alias("q_rows"), F.max("gci_and_billing_client_name").alias(
        "gci_and_billing_client_name"), F.sum("billing_amount").cast(RP.AMOUNT).alias("q_sum_amount"))
    assert rows_of(df, want.columns) == rows_of(want, want.columns)
