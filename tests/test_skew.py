"""The report on skewed inputs: hot line groups, hot and null references."""

import pytest
from pyspark.sql import functions as F

from spendlane.plans import lines as L
from spendlane.plans import report as RP
from spendlane.plans.context import ReportContext
from spendlane.registry import WHOLE
from spendlane.sources.views import Views

# output: (export column, import column) of the joined rows, greatest of the first that is set
ROW_LEVEL = {
    "po": ("po_bueno", "po"), "final_lane": ("lane_exp", "lane"), "final_consignee": ("consignee", "consignee_name"),
    "delivery": ("dlv", "dlv"), "bkd": ("bkd", "bkd"), "qty": ("qty", "qty"), "en_reference": ("en", "en"),
    "house_bill": ("ei_file_number", "ei_file_number"), "ship_date": ("cob", "departure_event_date_time"),
}


def plain_report(ctx):
    """The report's definition, word by word: lines joined to all leg rows, then grouped."""
    rows = RP.attach_legs(ctx)
    first = lambda *c: F.coalesce(*[F.col(x) for x in c])
    hb = first("e_ei_file_number", "i_ei_file_number")
    bills = F.count_distinct(hb)

    def amount(c):
        return F.when(bills > 1, F.max(c)).otherwise(F.sum(c))

    return rows.groupBy(*RP.GROUP_KEYS).agg(
        amount("billing_amount").cast(RP.AMOUNT).alias("billing_amount"),
        amount("billing_amount_usd").cast(RP.AMOUNT_USD).alias("billing_amount_usd"),
        bills.alias("hb_count"),
        *[F.max(first(f"e_{e}", f"i_{i}")).alias(o) for o, (e, i) in ROW_LEVEL.items()],
        F.max(first("e_frt", "i_frt", "i_fnd")).alias("freight"),
        F.max(first("e_adu", "e_afd", "i_add", "i_adu", "i_afd")).alias("arrival"),
        F.max(first("i_hazard_flag", "e_hazard_flag")).alias("hazard_flag"),
        F.coalesce(F.max("e_eda"), F.max("i_eda")).alias("eda"),
        F.max(first("e_destination_branch_country_name", "i_destination_branch_country_name", "billing_branch_country_name"))
        .alias("destination_country"),
        F.sum(first("e_volume_exp", "i_volume")).cast(RP.AMOUNT).alias("final_volume"),
        F.max(F.year(first("e_cob", "i_departure_event_date_time"))).alias("year"),
        F.max("c_container_count").alias("container_count"), F.max("c_containers").alias("containers"),
        F.max("charge_type").alias("charge_type"), F.max("ship_mode").alias("ship_mode"), F.max("f2f_flag").alias("f2f_flag"),
    )


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(ctx):
    want = plain_report(ctx)
    got = RP.grouped_report(ctx)
    clean = [c for c in want.columns if c != "final_consignee"]
    assert rows_of(got, clean) == rows_of(want, clean)
    return got


def skewed(spark, sf_dir):
    """A third of the lines repeat one line, a third refer to one invoice that both
    legs know or to none; movements without an invoice, export rows without values."""
    v = Views(spark, sf_dir)
    fact = v.customer_invoice_fact
    known = (v.import_shipment_fact.select("invoice_number").join(v.invoice_movement.select("invoice_number"), "invoice_number")
             .agg(F.min("invoice_number")).first()[0])
    h = F.pmod(F.xxhash64("invoice_number", "invoice_line_number"), F.lit(6))
    fact = fact.withColumn("internal_reference", F.when(h == 0, F.lit(known)).when(h == 1, F.lit(None)).otherwise(F.col("internal_reference")))
    # a line that reaches the report, repeated
    ctx = ReportContext(v, WHOLE)
    v.customer_invoice_fact = fact
    one = L.invoice_lines(ctx).orderBy("invoice_expeditor", "invoice_expeditor_line").select("invoice_expeditor", "invoice_expeditor_line").first()
    n = fact.count() // 2
    line = fact.where((F.col("invoice_number") == one[0]) & (F.col("invoice_line_number") == one[1]))
    v.customer_invoice_fact = fact.unionByName(
        line.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(n)))).select(*fact.columns))
    v.invoice_movement = v.invoice_movement.withColumn(
        "invoice_number", F.when(F.pmod(F.xxhash64("movement_id"), F.lit(3)) > 0, F.col("invoice_number")))
    t = v.shipment_fact_events_timeline
    v.shipment_fact_events_timeline = t.withColumn(
        "cob_event_time_first", F.when(F.pmod(F.col("shipment_fact_key"), F.lit(3)) > 0, F.col("cob_event_time_first"))).withColumn(
        "cob_event_time_earliest", F.when(F.pmod(F.col("shipment_fact_key"), F.lit(3)) > 0, F.col("cob_event_time_earliest")))
    s = v.import_shipment_fact
    v.import_shipment_fact = s.withColumn("invoice_number", F.when(F.pmod(F.xxhash64("invoice_number"), F.lit(5)) > 0, F.col("invoice_number")))
    return ReportContext(v, WHOLE), n


@pytest.fixture(scope="module")
def hot(spark, sf_dir):
    return skewed(spark, sf_dir)


def nodes(plan):
    """All nodes of a final adaptive plan."""
    out, todo = [], [plan]
    while todo:
        n = todo.pop()
        name = n.nodeName()
        out.append(n)
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(n.executedPlan())
        elif "QueryStage" in name:
            todo.append(n.plan())
        for i in range(n.children().size()):
            todo.append(n.children().apply(i))
    return out


def test_report_equals_its_definition(spark, sf_dir):
    same(ReportContext.from_dir(spark, sf_dir, WHOLE))


def test_skewed_report_equals_its_definition(hot):
    got = same(hot[0])
    assert got.where("internal_reference IS NULL").count() > 0


def test_hot_group_is_combined_before_its_shuffle(spark, hot):
    """A third of the lines on one key reach the shuffle as one state per task."""
    ctx, n = hot
    df = RP.lines_per_group(ctx)
    assert df.agg(F.max("q_rows")).first()[0] >= n
    groups, lines = df.count(), L.invoice_lines(ctx).count()
    assert lines > n * 2.5
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    written = [x.metrics().get("shuffleRecordsWritten").get().value() for x in nodes(plan)
               if x.nodeName() == "Exchange" and "invoice_expeditor_line" in x.simpleString(200)]
    assert written and max(written) <= groups + 64 < groups + n
    assert "partial_max" in plan.toString()


def test_no_full_outer_join_and_no_null_invoices(spark, hot):
    """Legs are reduced per invoice and joined to the lines by left joins; rows
    without an invoice are gone before the shuffle."""
    df = RP.grouped_report(hot[0])
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in text
    from spendlane.plans.legs_per_invoice import export_per_invoice, import_per_invoice

    for leg in (export_per_invoice, import_per_invoice):
        rows = leg(hot[0])
        assert rows.where("leg_invoice IS NULL").count() == 0
        assert rows.count() == rows.select("leg_invoice").distinct().count() > 0
