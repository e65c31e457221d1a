"""The spend report (R7) and its variants (R8-R10)."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlane.functions import rules as R
from spendlane.functions.published import PUBLISHED_NAMES
from spendlane.plans.containers import CONTAINER_COLUMNS, containers
from spendlane.plans.context import ReportContext
from spendlane.plans.export_leg import export_leg
from spendlane.plans.import_leg import import_leg
from spendlane.plans.legs_per_invoice import SUMMED, with_legs
from spendlane.plans.lines import GROUP_KEYS, LINE_MAXED, REFERENCE, invoice_lines, lines_per_group

AMOUNT = "decimal(38,2)"
AMOUNT_USD = "decimal(38,6)"


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def attach_legs(ctx: ReportContext) -> DataFrame:
    """Invoice lines left-joined to the import and export legs on the internal
    reference (legs never drop a line; an invoice with n export rows gives n
    rows) and then to the containers of the export movement, or of the import
    house bill when there is no export row."""
    q = invoice_lines(ctx)
    i = _prefixed(import_leg(ctx), "i_")
    e = _prefixed(export_leg(ctx), "e_")
    c = _prefixed(containers(ctx), "c_")
    return (q.join(i, q.internal_reference == i.i_invoice_number, "left")
            .join(e, q.internal_reference == e.e_invoice_number, "left")
            .join(c, F.coalesce(e.e_ei_file_number, i.i_ei_file_number) == c.c_ei_file_number, "left"))


REPORT_COLUMNS = [
    "invoice_date_time", "invoice_expeditor", "invoice_expeditor_line",
    "billing_line_description", "internal_reference", "billing_code", "invoice_date",
    "billing_amount", "usd_average_exchange_rate", "billing_amount_usd", "final_volume",
    "final_chweight", "actual_weight", "billing_client_id", "billing_client_name",
    "gci_and_billing_client_name", "billing_currency", "billing_branch_code",
    "customer_invoice_type", "billing_master_client_number", "billing_master_client_name",
    "invoice_year", "invoice_month", "billing_branch_country_name", "ship_mode",
    "billing_client_usage_distinction_type", "f2f_flag", "bill_to_customer_flag",
    "charge_type", "invoice_month_number", "po", "origin_branch", "destination_country",
    "service_type_code", "final_lane", "final_shipper", "house_bill", "hb_count",
    "final_consignee", "final_origin_branch", "final_destination_branch",
    "final_service_level", "we_move_yn", "freight", "ship_date", "arrival", "delivery",
    "eda", "edi", "eds", "proof_of_delivery", "bkd", "month", "quarter", "year",
    "shipper_address1", "shipper_address2", "shipper_state", "shipper_city",
    "consignee_address1", "consignee_address2", "consignee_state", "consignee_city",
    "invoice_month2", "invoice_quarter", "hazard_flag", "origin_branch_region_code",
    "destination_branch_region_code", "container_count", "containers", "container_sizes",
    "qty", "en_reference", "ci_reference", "mb_reference", "dp_reference",
]


# how a text is cleaned for the delimited export
CLEANED = {
    "final_shipper": R.strip_quotes, "final_consignee": R.strip_quotes,
    "shipper_address1": R.sanitise, "shipper_address2": R.sanitise, "shipper_city": R.sanitise,
    "consignee_address1": R.sanitise, "consignee_address2": R.sanitise, "consignee_city": R.sanitise,
}


FROM_LINES = ("bill_to_customer_flag", "destination_country")  # computed from some of LINE_MAXED


def grouped_report(ctx: ReportContext, columns: Collection[str] = tuple(REPORT_COLUMNS)) -> DataFrame:
    """The report grouped on its seven keys (description still raw): line
    groups joined to the leg values of their invoice (see
    :mod:`spendlane.plans.legs_per_invoice`).  Lines are never multiplied by leg
    rows; sums over the joined rows are the line sums times the leg rows, and the
    leg sums times the line rows."""
    lists, texts = (not set(columns).isdisjoint(c) for c in (CONTAINER_COLUMNS, (*LINE_MAXED, *FROM_LINES)))
    return _report_rows(ctx, with_legs(ctx, lines_per_group(ctx, texts), REFERENCE, lists), columns)


def _report_rows(ctx: ReportContext, df: DataFrame, columns: Collection[str]) -> DataFrame:
    hb_count, leg_rows = F.col("hb_count"), F.col("n_leg_rows")

    def amount(name: str, kind: str) -> Column:
        total = F.col(f"q_sum_{name}") * leg_rows
        return F.when(hb_count > 1, F.col(f"q_max_{name}")).otherwise(total).cast(kind)

    cols = {c: f(c) for c, f in CLEANED.items()}
    # what follows from a group's key alone is computed here, after all shuffles
    cols["ship_mode"] = R.ship_mode("internal_reference")
    cols["charge_type"] = R.charge_type("billing_code", F.col("billing_line_description"), merged=ctx.params.merged_charges)
    cols["invoice_month_number"] = F.month("invoice_date")
    cols["invoice_month2"] = R.month_label("invoice_date_time")
    cols["invoice_quarter"] = R.quarter_label("invoice_date")
    cols |= {c: (F.col("q_rows") * F.col(c)).cast(AMOUNT) for c in SUMMED}
    cols["destination_country"] = F.greatest(
        "leg_country", F.when(F.col("country_open"), F.col("billing_branch_country_name")))
    cols["billing_amount"] = amount("amount", AMOUNT)
    cols["billing_amount_usd"] = amount("amount_usd", AMOUNT_USD)
    cols["bill_to_customer_flag"] = R.bill_to_flag_final("f2f_flag", "billing_client_usage_distinction_type")
    return df.select(*[cols.get(c, F.col(c)).alias(c) for c in REPORT_COLUMNS if c in columns])


def _finish(grouped: DataFrame) -> DataFrame:
    # the grouping key is the raw text; the published column is sanitised
    return grouped.withColumn("billing_line_description", R.sanitise("billing_line_description"))


def spend_report(ctx: ReportContext, columns: Collection[str] = tuple(REPORT_COLUMNS)) -> DataFrame:
    """R7-R10: one row per (invoice time, invoice, line, billing code, raw
    description, internal reference, invoice date); 76 columns, or the keys and those of
    ``columns``: containers are then met only if one of these shows them, and lines travel without the
    keys of small dimensions whose texts none of them shows."""
    return _finish(grouped_report(ctx, (*GROUP_KEYS, *columns)))


PACKED_LINES = 16  # line numbers of an invoice that may share a row on their way to the order
PACK = 1 << 12  # line groups that one row takes
# what the lines of an invoice mostly have in common
SHARED = ["internal_reference", "invoice_date", "invoice_year", "invoice_month", "billing_client_id", "billing_client_name",
          "gci_and_billing_client_name", "billing_master_client_number", "billing_master_client_name",
          "billing_client_usage_distinction_type"]


def _packed(groups: DataFrame) -> DataFrame:
    """Line groups that lie together, as arrays: one row for each reference, invoice time,
    invoice, :data:`PACKED_LINES` line numbers and :data:`SHARED` values, or several if that
    is many groups."""
    by = [REFERENCE, "invoice_date_time", "invoice_expeditor", "_lines", *SHARED]
    rows = groups.withColumn("_lines", F.floor(F.col("invoice_expeditor_line") / PACKED_LINES)).withColumn(
        "_pack", F.floor(F.monotonically_increasing_id() / PACK))
    inner = [c for c in groups.columns if c not in by]
    return rows.groupBy(*by, "_pack").agg(F.collect_list(F.struct(*inner)).alias("_groups")).drop("_pack")


def spend_report_sorted(ctx: ReportContext) -> DataFrame:
    """The report in its published order: the seven keys ascending (raw
    description), nulls last; a global range sort.

    Line groups travel to their range in packs, with the leg values once: ranges are cut
    between invoice times, invoices and runs of line numbers, which ascend with the keys,
    and inside a range the unpacked rows are sorted by all of them."""
    packs = with_legs(ctx, _packed(lines_per_group(ctx)), REFERENCE)
    by = [F.col(c).asc_nulls_last() for c in ("invoice_date_time", "invoice_expeditor", "_lines")]
    rows = packs.repartitionByRange(*by).select("*", F.inline("_groups"))
    grouped = _report_rows(ctx, rows, REPORT_COLUMNS)
    return _finish(grouped.sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in GROUP_KEYS]))


def published(report: DataFrame) -> DataFrame:
    """The report under its published column names."""
    return report.select(*[F.col(c).alias(PUBLISHED_NAMES[c]) for c in REPORT_COLUMNS])
