"""Registered queries: one per operator / job of the report.

Each entry pairs a Spark builder ``(spark, base_dir) -> DataFrame`` with the
DuckDB statement that must give the same rows (see :mod:`spendlane.oracle`).
Report-level queries use :data:`WHOLE` (no restriction at all), so
they run over the whole tables; the scoping queries exist to show a scope and
use the report's own kind of parameters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlane import oracle as O
from spendlane.functions import constants as K
from spendlane.functions import rules as R
from spendlane.operators.joins import left_join_filtered
from spendlane.operators.pivots import max_code_milestones
from spendlane.operators.scope import keep_code_country
from spendlane.params import ReportParams
from spendlane.plans import containers as C
from spendlane.plans import export_leg as X
from spendlane.plans import import_leg as I
from spendlane.plans import lines as L
from spendlane.plans import report as RP
from spendlane.plans.context import ReportContext
from spendlane.sources.views import VIEW_NAMES


def ref_text(key: int) -> str:
    """Python twin of the reference rule, used only to name spot-check
    invoices in parameters."""
    prefix = ("J" if key % 11 == 0 else "H" if key % 13 == 0 else "X" if key % 17 == 0
              else str(1 + key % 9))
    return f"{prefix}{key}"


WHOLE = ReportParams()  # every client, every date
MASTER_SCOPE = ReportParams(client_ids=("M1", "M3"))
GCI_SCOPE = ReportParams(client_type="GCI", client_ids=("G11", "G13"))
DATE_SCOPE = ReportParams(start=dt.date(1996, 1, 1),
                          end=dt.date(1999, 12, 31))
PORT_VARIANT = ReportParams(variant="port_country")
# spot checks: invoice numbers of the lines ("E" + order) and of the legs
# (reference form) for orders in the import leg, the export leg and both
_SPOT_ORDERS = (1, 4, 6, 8, 18, 28)
SPOT_INVOICES = tuple(f"E{k}" for k in _SPOT_ORDERS) + tuple(ref_text(k) for k in _SPOT_ORDERS)
SCOPED = ReportParams(variant="port_country",
                      invoice_numbers=SPOT_INVOICES)
SINGLE = ReportParams(invoice_numbers=("E8", ref_text(8)),
                      scope_export_references=False, scope_final=False)


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


def _ctx(spark: SparkSession, base_dir: str, p: ReportParams) -> ReportContext:
    return ReportContext.from_dir(spark, base_dir, p)


def _q(params: ReportParams, fn: Callable[[ReportContext], DataFrame]):
    return lambda spark, base_dir: fn(_ctx(spark, base_dir, params))


# --------------------------------------------------------------- Spark side

def scan_views(ctx: ReportContext) -> DataFrame:
    v = ctx.views
    out = None
    for n in VIEW_NAMES:
        c = v.get(n).groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("view"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def role_dimensions(ctx: ReportContext) -> DataFrame:
    return I.import_shipments(ctx).select(
        "invoice_number",
        F.col("sh_gci_name").alias("shipper_name"),
        F.col("cn_gci_name").alias("consignee_name"),
        F.col("bo_branch_code").alias("origin_branch_code"),
        F.col("bd_branch_code").alias("destination_branch_code"),
        F.col("po_port_code").alias("origin_port_code"),
        F.col("pd_port_code").alias("destination_port_code"))


def _scope_view(ctx: ReportContext) -> DataFrame:
    return L.invoice_lines(ctx).select(
        "invoice_expeditor", "invoice_expeditor_line", "billing_client_id",
        "billing_master_client_number", "invoice_date")


def exclude_code_country(ctx: ReportContext) -> DataFrame:
    df = L.enriched_lines(ctx)
    kept = F.coalesce(keep_code_country(F.col("billing_code"), F.col("country_code")), F.lit(False))
    return df.groupBy(
        "billing_code", F.col("country_code").alias("billing_branch_country_code"),
        kept.alias("kept")).agg(F.count(F.lit(1)).alias("n_lines"))


def spend_by_charge_type(ctx: ReportContext) -> DataFrame:
    return L.invoice_lines(ctx).groupBy("charge_type", "billing_code").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("billing_amount").cast(RP.AMOUNT).alias("billing_amount"),
        F.sum("billing_amount_usd").cast(RP.AMOUNT_USD).alias("billing_amount_usd"))


def reference_pivot_q(ctx: ReportContext) -> DataFrame:
    return I.import_references(ctx)


def import_milestones(ctx: ReportContext) -> DataFrame:
    return max_code_milestones(I.import_event_extremes(ctx), "invoice_no", K.IMPORT_MILESTONES)


def export_edi_events(ctx: ReportContext) -> DataFrame:
    from spendlane.operators.pivots import event_extremes
    ext = event_extremes(ctx.views.event, "invoice_no", K.EXPORT_EVENT_CODES, drop_deleted=False)
    return max_code_milestones(ext, "invoice_no", K.EXPORT_MILESTONES)


def left_join_filtered_right(ctx: ReportContext) -> DataFrame:
    isf = ctx.views.import_shipment_fact.select("invoice_number")
    # reduce the tall side to one row per (invoice, type) first (map-side
    # combinable), then apply the type predicate of the ON clause to it
    counted = (ctx.views.reference.groupBy("invoice_no", "reference_type")
               .agg(F.count("reference_no").alias("n")))
    joined = left_join_filtered(isf, counted, isf.invoice_number == counted.invoice_no,
                                F.col("reference_type").isin(*K.IMPORT_REFERENCE_TYPES))
    return joined.groupBy("invoice_number").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_refs"))


def f2f_flags(ctx: ReportContext) -> DataFrame:
    return L.invoice_lines(ctx).groupBy(
        "billing_line_description", "billing_client_usage_distinction_type", "f2f_flag"
    ).agg(F.count(F.lit(1)).alias("n_lines"))


def we_move_flags(ctx: ReportContext) -> DataFrame:
    imp = I.import_leg(ctx).select(F.lit("import").alias("leg"),
                                   F.col("invoice_number").alias("id"), "we_move")
    exp = X.export_references(ctx).select(F.lit("export").alias("leg"),
                                          F.col("so_ei_file_number").alias("id"), "we_move")
    return imp.unionByName(exp)


def bill_to_flags(ctx: ReportContext) -> DataFrame:
    df = L.invoice_lines(ctx)
    return df.groupBy(
        "f2f_flag", "billing_client_usage_distinction_type",
        F.col("bill_to_customer_flag").alias("bill_to_line"),
        R.bill_to_flag_final("f2f_flag", "billing_client_usage_distinction_type").alias("bill_to_final"),
    ).agg(F.count(F.lit(1)).alias("n_lines"))


def first_row_per_movement(ctx: ReportContext) -> DataFrame:
    return C.first_rows(ctx, 1).select("movement_id",
                                       F.col("container_number").alias("first_container"))


def ship_modes(ctx: ReportContext) -> DataFrame:
    return L.invoice_lines(ctx).groupBy(
        F.substring("internal_reference", 1, 1).alias("prefix"), "ship_mode"
    ).agg(F.count(F.lit(1)).alias("n_lines"))


def sanitise_text(ctx: ReportContext) -> DataFrame:
    v = ctx.views
    texts = v.customer_invoice_fact.select(F.col("billing_line_description").alias("raw_text"))
    for c in ("gci_name", "gci_addr_line1", "gci_city"):
        texts = texts.unionByName(v.client_dimension.select(F.col(c).alias("raw_text")))
    return texts.distinct().select(
        "raw_text", R.sanitise("raw_text").alias("sanitised_text"),
        R.strip_quotes("raw_text").alias("unquoted_text"))


def lanes(ctx: ReportContext) -> DataFrame:
    imp = I.import_leg(ctx).select(F.lit("import").alias("leg"),
                                   F.col("invoice_number").alias("id"), "lane")
    exp = X.export_leg_base(ctx).select(F.lit("export").alias("leg"),
                                        F.col("ei_file_number").alias("id"),
                                        F.col("lane_exp").alias("lane"))
    return imp.unionByName(exp).distinct()


def client_labels(ctx: ReportContext) -> DataFrame:
    c = ctx.views.client_dimension
    return c.select("gci", R.client_label("gci", "gci_name").alias("gci_and_billing_client_name"))


def billing_amount_usd(ctx: ReportContext) -> DataFrame:
    return L.invoice_lines(ctx).select(
        "invoice_expeditor", "invoice_expeditor_line", "billing_amount",
        "usd_average_exchange_rate",
        F.col("billing_amount_usd").cast(RP.AMOUNT_USD).alias("billing_amount_usd"))


def calendar_labels(ctx: ReportContext) -> DataFrame:
    return L.invoice_lines(ctx).groupBy(
        "invoice_month_number",
        R.month_label("invoice_date_time").alias("invoice_month2"),
        R.quarter_label("invoice_date").alias("invoice_quarter"),
        "invoice_year",
    ).agg(F.count(F.lit(1)).alias("n_lines"))


def _report_subset(cols: tuple[str, ...]):
    def build(ctx: ReportContext) -> DataFrame:
        return RP.spend_report(ctx, cols).select(*RP.GROUP_KEYS, *cols)
    return build


LEADS = (0, 1, K.ROLLUP_WIDTH - 1)  # the first, the next and the last that a list takes
LEG_COALESCE_COLS = ("freight", "ship_date", "arrival", "delivery", "eda", "edi", "eds",
                     "proof_of_delivery", "bkd")
FANOUT_COLS = ("billing_amount", "billing_amount_usd", "hb_count")
HB_COLS = ("house_bill", "hb_count")
MEASURE_COLS = ("final_volume", "final_chweight", "actual_weight")


def optional_service_type(ctx: ReportContext) -> DataFrame:
    isf = ctx.views.import_shipment_fact.select("invoice_number", "service_type_key")
    return isf.join(ctx.service_types, "service_type_key", "left").select(
        "invoice_number", "service_type_key", "service_type_code")


def attach_legs_q(ctx: ReportContext) -> DataFrame:
    return RP.attach_legs(ctx).select(
        "invoice_expeditor", "invoice_expeditor_line", "internal_reference",
        F.col("i_ei_file_number").alias("import_house_bill"),
        F.col("e_ei_file_number").alias("export_movement"),
        F.col("e_po_bueno").alias("export_po"))


def attach_containers_q(ctx: ReportContext) -> DataFrame:
    return RP.attach_legs(ctx).select(
        "invoice_expeditor", "invoice_expeditor_line",
        F.coalesce("e_ei_file_number", "i_ei_file_number").alias("house_bill"),
        F.col("c_container_count").alias("container_count"),
        F.col("c_containers").alias("containers"))


def lead_offsets(ctx: ReportContext) -> DataFrame:
    return C.number_leads(ctx, LEADS)


def running_count(ctx: ReportContext) -> DataFrame:
    return C.running_counts(ctx)


# --------------------------------------------------------------- oracle side

LEGS = ("import_leg", "movement_refs", "export_base")
SCOPE_SQL = ("SELECT invoice_expeditor, invoice_expeditor_line, billing_client_id, "
             "billing_master_client_number, invoice_date FROM lines")
CHARGE_SQL = """
SELECT charge_type, billing_code, count(*) AS n_lines,
       CAST(sum(billing_amount) AS DECIMAL(38,2)) AS billing_amount,
       CAST(sum(billing_amount_usd) AS DECIMAL(38,6)) AS billing_amount_usd
FROM lines GROUP BY ALL"""


def _views_sql() -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS \"view\", count(*) AS n_rows FROM v_{n}" for n in VIEW_NAMES)


def _texts_sql() -> str:
    texts = " UNION ".join(["SELECT billing_line_description AS raw_text FROM v_customer_invoice_fact",
                            *[f"SELECT {c} FROM v_client_dimension" for c in ("gci_name", "gci_addr_line1", "gci_city")]])
    return (f"SELECT raw_text, {O.sanitised('raw_text')} AS sanitised_text, {O.unquoted('raw_text')} AS unquoted_text "
            f"FROM ({texts})")


def _subset_sql(cols: tuple[str, ...]) -> str:
    return f"SELECT {', '.join((*RP.GROUP_KEYS, *cols))} FROM ({O.report_body()})"


# query: (parameters, Spark side, statement, parts of the report that the statement reads)
_TABLE: dict[str, tuple] = {
    "scan_views": (WHOLE, scan_views, _views_sql()),
    "role_dimensions": (WHOLE, role_dimensions, """
SELECT invoice_number, shipper_name, consignee_name, origin_branch_code, destination_branch_code,
       origin_port_code, destination_port_code FROM imports""", "imports"),
    "invoice_lines": (WHOLE, L.invoice_lines, "SELECT * FROM lines", "lines"),
    "client_scope_master": (MASTER_SCOPE, _scope_view, SCOPE_SQL, "lines"),
    "client_scope_gci": (GCI_SCOPE, _scope_view, SCOPE_SQL, "lines"),
    "date_scope": (DATE_SCOPE, _scope_view, SCOPE_SQL, "lines"),
    "exclude_code_country": (WHOLE, exclude_code_country, """
SELECT billing_code, billing_branch_country_code,
       coalesce(billing_code || billing_branch_country_code <> '2125MX', false) AS kept, count(*) AS n_lines
FROM all_lines GROUP BY ALL""", "all_lines"),
    "charge_type": (WHOLE, spend_by_charge_type, CHARGE_SQL, "lines"),
    "charge_type_merged": (PORT_VARIANT, spend_by_charge_type, CHARGE_SQL, "lines"),
    "reference_pivot": (WHOLE, reference_pivot_q, """
SELECT * EXCLUDE (ref_so) FROM refs
WHERE invoice_no IN (SELECT invoice_no FROM v_reference WHERE reference_type <> 'SO')""", "refs"),
    "import_milestones": (WHOLE, import_milestones,
                          f"SELECT invoice_no, {O.times(O.IMPORT_TIMES)} FROM import_events", "import_events"),
    "export_edi_events": (WHOLE, export_edi_events,
                          f"SELECT invoice_no, {O.times(O.EXPORT_EVENTS)} FROM export_events", "export_events"),
    "ocean_movements": (WHOLE, C.ocean_movements, "SELECT movement_id FROM ocean", "ocean"),
    "left_join_filtered_right": (WHOLE, left_join_filtered_right, """
SELECT invoice_number, coalesce(sum(n), 0)::BIGINT AS n_refs
FROM (SELECT DISTINCT invoice_number FROM v_import_shipment_fact) s
LEFT JOIN (SELECT invoice_no, count(*) AS n FROM v_reference WHERE reference_type <> 'SO' GROUP BY invoice_no) r
       ON invoice_no = invoice_number
GROUP BY invoice_number"""),
    "f2f_flag": (WHOLE, f2f_flags, """
SELECT billing_line_description, billing_client_usage_distinction_type, f2f_flag, count(*) AS n_lines
FROM lines GROUP BY ALL""", "lines"),
    "we_move_flag": (WHOLE, we_move_flags, """
SELECT 'import' AS leg, invoice_number AS id, we_move FROM import_leg
UNION ALL SELECT 'export', so_ei_file_number, we_move FROM movement_refs""", *LEGS[:2]),
    "bill_to_flag": (WHOLE, bill_to_flags, """
SELECT f2f_flag, billing_client_usage_distinction_type, bill_to_customer_flag AS bill_to_line,
       if(f2f_flag = 'Y' AND billing_client_usage_distinction_type IS DISTINCT FROM 'F2FC', 'N', 'Y') AS bill_to_final,
       count(*) AS n_lines FROM lines GROUP BY ALL""", "lines"),
    "first_row_per_movement": (WHOLE, first_row_per_movement, """
SELECT movement_id, min(container_number) AS first_container FROM ocean_containers GROUP BY movement_id""",
                               "ocean_containers"),
    "ship_mode": (WHOLE, ship_modes, """
SELECT internal_reference[1] AS prefix, ship_mode, count(*) AS n_lines FROM lines GROUP BY ALL""", "lines"),
    "sanitise_text": (WHOLE, sanitise_text, _texts_sql()),
    "lane": (WHOLE, lanes, """
SELECT 'import' AS leg, invoice_number AS id, lane FROM import_leg
UNION SELECT 'export', ei_file_number, lane_exp FROM export_base""", *LEGS),
    "client_label": (WHOLE, client_labels, """
SELECT gci, gci || ' - ' || gci_name AS gci_and_billing_client_name FROM v_client_dimension"""),
    "billing_amount_usd": (WHOLE, billing_amount_usd, """
SELECT invoice_expeditor, invoice_expeditor_line, billing_amount, usd_average_exchange_rate,
       CAST(billing_amount_usd AS DECIMAL(38,6)) AS billing_amount_usd FROM lines""", "lines"),
    "calendar_labels": (WHOLE, calendar_labels, f"""
SELECT invoice_month_number, {O.month_label('invoice_date_time')} AS invoice_month2,
       {O.quarter_label('invoice_date')} AS invoice_quarter, invoice_year, count(*) AS n_lines
FROM lines GROUP BY ALL""", "lines"),
    "import_leg": (WHOLE, I.import_leg, "SELECT * FROM import_leg", "import_leg"),
    "export_leg_base": (WHOLE, X.export_leg_base, "SELECT * FROM export_base", "export_base"),
    "export_references": (WHOLE, X.export_references, "SELECT * FROM movement_refs", "movement_refs"),
    "export_leg": (WHOLE, X.export_leg, "SELECT * FROM export_leg", "export_leg"),
    "container_rollup": (WHOLE, lambda c: C.containers(c).select("ei_file_number", "containers", "container_count"),
                         "SELECT * EXCLUDE (container_sizes) FROM container_lists", "container_lists"),
    "container_size_rollup": (WHOLE, lambda c: C.containers(c).select("ei_file_number", "container_sizes"),
                              "SELECT ei_file_number, container_sizes FROM container_lists", "container_lists"),
    "containers": (WHOLE, C.containers, "SELECT * FROM container_lists", "container_lists"),
    "lead_offsets": (WHOLE, lead_offsets, f"""
SELECT movement_id, container_number, row_number() OVER w AS position,
       {', '.join(f"lead(container_number, {k}, NULL) OVER w AS lead_{k}" for k in LEADS)}
FROM ocean_containers WINDOW w AS (PARTITION BY movement_id ORDER BY container_number NULLS LAST)""", "ocean_containers"),
    "running_count": (WHOLE, running_count, """
SELECT movement_id, container_number,
       count(container_number) OVER (PARTITION BY movement_id ORDER BY container_number DESC NULLS LAST) AS container_count
FROM ocean_containers""", "ocean_containers"),
    "optional_service_type": (WHOLE, optional_service_type, """
SELECT invoice_number, s.service_type_key, service_type_code
FROM v_import_shipment_fact s LEFT JOIN v_service_type_dimension USING (service_type_key)"""),
    "attach_legs": (WHOLE, attach_legs_q, """
SELECT q.invoice_expeditor, q.invoice_expeditor_line, q.internal_reference, i.ei_file_number AS import_house_bill,
       e.ei_file_number AS export_movement, e.po_bueno AS export_po FROM attached""", "attached"),
    "attach_containers": (WHOLE, attach_containers_q, """
SELECT q.invoice_expeditor, q.invoice_expeditor_line, hb AS house_bill, c.container_count, c.containers
FROM attached""", "attached"),
    "leg_coalesce": (WHOLE, _report_subset(LEG_COALESCE_COLS), _subset_sql(LEG_COALESCE_COLS), "attached"),
    "fanout_safe_amount": (WHOLE, _report_subset(FANOUT_COLS), _subset_sql(FANOUT_COLS), "attached"),
    "house_bill_count": (WHOLE, _report_subset(HB_COLS), _subset_sql(HB_COLS), "attached"),
    "leg_measures": (WHOLE, _report_subset(MEASURE_COLS), _subset_sql(MEASURE_COLS), "attached"),
    "spend_report": (WHOLE, RP.spend_report, O.report_body(), "attached"),
    "spend_report_sorted": (WHOLE, RP.spend_report_sorted, O.report_body(), "attached"),
    "spend_report_port_country": (PORT_VARIANT, RP.spend_report, O.report_body(), "attached"),
    "scoped_report": (SCOPED, RP.spend_report, O.report_body(), "attached"),
    "scoped_report_single": (SINGLE, RP.spend_report, O.report_body(), "attached"),
}

QUERIES: dict[str, Query] = {
    name: Query(_q(p, build), O.statement(p, body, *needed)) for name, (p, build, body, *needed) in _TABLE.items()
}
