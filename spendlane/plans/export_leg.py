"""Export leg: references per movement (R3), the movement x invoice x PO base
(R4) and their join (R5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.functions import constants as K
from spendlane.functions import rules as R
from spendlane.operators.pivots import max_code_milestone
from spendlane.plans.attributes import EXPORT, max_code, max_time, reference, with_attributes
from spendlane.plans.context import ReportContext, leg_roles

ROLES = leg_roles("branch_origin_key", "branch_dest_key", "outbound_shipper_key", "outbound_consignee_key",
                  ("port_origin_key", "port_dest_key"), ("op_", "dp_"))


def scoped_shipments(ctx: ReportContext) -> DataFrame:
    """Export shipments whose outbound revenue client is in scope; if the run names
    invoices, those of their :func:`wanted_movements` only."""
    return ctx.memo("scoped_shipments", lambda: _scoped_shipments(ctx))


def invoice_movements(ctx: ReportContext) -> DataFrame:
    """movement_id, invoice_number of the run's invoices."""
    return ctx.memo("invoice_movements", lambda: ctx.in_invoice_scope(ctx.views.invoice_movement, "invoice_number"))


def wanted_movements(ctx: ReportContext) -> DataFrame | None:
    """The movements that carry the run's invoices or are their import shipments' house
    bills, all that a report can show; None if the run names no invoices."""
    from spendlane.plans.import_leg import scoped_imports

    if not ctx.scopes_invoices:
        return None

    def build() -> DataFrame:
        carried = invoice_movements(ctx).select(F.col("movement_id").alias("wanted_id"))
        bills = scoped_imports(ctx).select(F.col("housebill_ref").alias("wanted_id"))
        return ctx.chosen(carried.unionByName(bills).distinct())
    return ctx.memo("wanted_movements", build)


def of_wanted(ctx: ReportContext, df: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``movement_id`` the run wants, before any other join."""
    ids = wanted_movements(ctx)
    return df if ids is None else df.join(ids, df.movement_id == ids.wanted_id, "left_semi")


def _scoped_shipments(ctx: ReportContext) -> DataFrame:
    sf = of_wanted(ctx, ctx.views.shipment_fact)
    clients = ctx.scoped_clients.select("client_key", "master_client_number", "gci")
    return sf.join(clients, sf.outbound_revenue_customer_key == clients.client_key).drop("client_key")


def scoped_movement_invoices(ctx: ReportContext) -> DataFrame:
    """movement_id, invoice_number of the scoped movements that the references
    are pooled over."""
    def build() -> DataFrame:
        im = invoice_movements(ctx) if ctx.params.scope_export_references else of_wanted(ctx, ctx.views.invoice_movement)
        ids = scoped_shipments(ctx).select("movement_id")
        return im.join(ids, "movement_id", "left_semi") if ctx.scoped else im
    return ctx.memo("scoped_movement_invoices", build)


def export_references(ctx: ReportContext) -> DataFrame:
    """R3 (``SO``): one row per scoped movement that has shipment references.

    Wide shipment references win over the tall reference table for SO, CI and
    EN.  A movement pools the references and EDA/EDI/EDS events of all its
    invoices; deleted events are *not* excluded on this leg.  Every tall
    table is first reduced to one row per movement or invoice.
    """
    return ctx.memo("export_references", lambda: _export_references(ctx))


def _export_references(ctx: ReportContext) -> DataFrame:
    sf = scoped_shipments(ctx).select("movement_id")
    srf = of_wanted(ctx, ctx.views.shipment_reference_fact).groupBy("movement_id").agg(
        F.max("so_references").alias("srf_so"),
        F.max("ci_references").alias("srf_ci"),
        F.max("en_references").alias("srf_en"))
    im = scoped_movement_invoices(ctx)
    per_invoice = with_attributes(ctx, sf.join(srf, "movement_id").join(im, "movement_id"), "invoice_number")
    ic = F.max(reference("IC"))
    code, time = F.max(max_code(EXPORT)), F.max(max_time(EXPORT))
    return per_invoice.groupBy(F.col("movement_id").alias("so_ei_file_number")).agg(
        F.coalesce(F.max("srf_so"), F.max(reference("SO"))).alias("so"),
        ic.alias("ic"),
        F.max(reference("PO")).alias("po"),
        R.we_move(ic).alias("we_move"),
        *[max_code_milestone(m, code, time).alias(m.lower()) for m in K.EXPORT_MILESTONES],
        F.coalesce(F.max("srf_ci"), F.max(reference("CI"))).alias("ci"),
        F.coalesce(F.max("srf_en"), F.max(reference("EN"))).alias("en"),
        F.max(reference("MB")).alias("mb"),
        F.max(reference("DP")).alias("dp"),
    )


EXPORT_BASE_KEYS = [
    "outbound_revenue_client_master_client_number", "revenue_gci", "ei_file_number",
    "weight_chargeable_exp", "actual_weight", "volume_exp", "invoice_number",
    "origin_branch_country_name", "destination_branch_country_name",
    "origin_branch", "destination_branch",
    "cob_event_time_first", "cob_event_time_earliest", "frt", "adu", "afd", "dlv", "pod", "bkd",
    "consignee", "outbound_consignee_address_line_1", "outbound_consignee_address_line_2",
    "outbound_consignee_state_province", "outbound_consignee_city",
    "shipper", "outbound_shipper_address_line_1", "outbound_shipper_address_line_2",
    "outbound_shipper_state_province", "outbound_shipper_city",
    "service_level", "exp_origin_port", "exp_destination_port", "hazard_flag",
    "origin_branch_region_code", "destination_branch_region_code", "po_bueno",
    "service_type_code",
]


def export_leg_base(ctx: ReportContext) -> DataFrame:
    """R4 (``EXP``): distinct movement x invoice x PO reference rows with the
    movement's parties, lanes and milestone times; ``MAX(pieces)`` per row."""
    return ctx.memo("export_leg_base", lambda: _export_leg_base(ctx))


def _export_leg_base(ctx: ReportContext) -> DataFrame:
    v = ctx.views
    sf = scoped_shipments(ctx)
    if ctx.scopes_invoices:
        sf = ctx.chosen(sf)
    sfe = v.shipment_fact_events_timeline
    im = invoice_movements(ctx)
    srf = of_wanted(ctx, v.shipment_reference_fact).select(
        F.col("movement_id").alias("srf_movement_id"), "po_references")
    # the narrow times first, the parties' texts for the last two shuffles, the
    # texts of the small dimensions for none
    df = (
        ctx.with_parties(sf.join(sfe, "shipment_fact_key"), ROLES)
        .join(im, "movement_id")
        .join(srf, F.col("movement_id") == F.col("srf_movement_id"), "left")
    )
    df = (
        ctx.with_places(df, ROLES)
        .join(ctx.service_levels, "service_level_key")
        .join(ctx.service_types, "service_type_key", "left")
    )
    countries = ("op_", "dp_") if ctx.params.port_countries else ("bo_", "bd_")
    return _export_base_select(df, countries)


def _export_base_select(df: DataFrame, countries: tuple[str, str]) -> DataFrame:
    keyed = df.select(
        F.col("master_client_number").alias("outbound_revenue_client_master_client_number"),
        F.col("gci").alias("revenue_gci"),
        F.col("movement_id").alias("ei_file_number"),
        F.col("weight_chargeable").alias("weight_chargeable_exp"),
        F.col("weight_actual").alias("actual_weight"),
        F.col("volume").alias("volume_exp"),
        F.col("invoice_number"),
        F.col(f"{countries[0]}country_name").alias("origin_branch_country_name"),
        F.col(f"{countries[1]}country_name").alias("destination_branch_country_name"),
        F.col("bo_branch_code").alias("origin_branch"),
        F.col("bd_branch_code").alias("destination_branch"),
        "cob_event_time_first", "cob_event_time_earliest",
        F.col("frt_event_time_first").alias("frt"),
        F.col("adu_event_time_first").alias("adu"),
        F.col("afd_event_time_first").alias("afd"),
        F.col("dlv_event_time_first").alias("dlv"),
        F.col("pod_event_time_latest").alias("pod"),
        F.col("bkd_event_time_first").alias("bkd"),
        F.col("cn_gci_name").alias("consignee"),
        F.col("cn_gci_addr_line1").alias("outbound_consignee_address_line_1"),
        F.col("cn_gci_addr_line2").alias("outbound_consignee_address_line_2"),
        F.col("cn_gci_state").alias("outbound_consignee_state_province"),
        F.col("cn_gci_city").alias("outbound_consignee_city"),
        F.col("sh_gci_name").alias("shipper"),
        F.col("sh_gci_addr_line1").alias("outbound_shipper_address_line_1"),
        F.col("sh_gci_addr_line2").alias("outbound_shipper_address_line_2"),
        F.col("sh_gci_state").alias("outbound_shipper_state_province"),
        F.col("sh_gci_city").alias("outbound_shipper_city"),
        F.col("service_level_description").alias("service_level"),
        F.col("op_port_code").alias("exp_origin_port"),
        F.col("dp_port_code").alias("exp_destination_port"),
        F.col("hazard_flag_yn").alias("hazard_flag"),
        F.col("bo_region_code_1").alias("origin_branch_region_code"),
        F.col("bd_region_code_1").alias("destination_branch_region_code"),
        F.col("po_references").alias("po_bueno"),
        "service_type_code",
        "pieces",
    )
    grouped = keyed.groupBy(*EXPORT_BASE_KEYS).agg(F.max("pieces").alias("qty"))
    return grouped.select(
        *EXPORT_BASE_KEYS[:9],
        R.lane("origin_branch", "destination_branch").alias("lane_exp"),
        "origin_branch", "destination_branch",
        F.coalesce("cob_event_time_first", "cob_event_time_earliest").alias("cob"),
        *EXPORT_BASE_KEYS[13:],
        "qty",
    )


def export_leg(ctx: ReportContext) -> DataFrame:
    """R5 (``EXPO``): export base rows of movements that have references."""
    return ctx.memo("export_leg", lambda: _export_leg(ctx))


def _export_leg(ctx: ReportContext) -> DataFrame:
    base = export_leg_base(ctx)
    so = export_references(ctx)
    return base.join(so, base.ei_file_number == so.so_ei_file_number)
