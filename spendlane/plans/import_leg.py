"""Import leg: one row per import invoice number (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.functions import constants as K
from spendlane.functions import rules as R
from spendlane.operators.pivots import event_extremes, max_code_milestone, reference_pivot
from spendlane.plans.attributes import IMPORT, max_code, max_time, reference, with_attributes
from spendlane.plans.containers import CONTAINER_COLUMNS, containers
from spendlane.plans.context import ReportContext, leg_roles

ROLES = leg_roles("branch_origin_key", "branch_destination_key", "shipper_key", "consignee_key",
                  ("port_origin_key", "port_destination_key"), ("po_", "pd_"))


def import_references(ctx: ReportContext) -> DataFrame:
    """IC, PO, CI, EN, MB, DP reference per invoice (one row per invoice)."""
    return reference_pivot(ctx.views.reference, "invoice_no", K.IMPORT_REFERENCE_TYPES)


def import_event_extremes(ctx: ReportContext) -> DataFrame:
    """Greatest listed code and latest time of live import events per invoice."""
    return event_extremes(ctx.views.event, "invoice_no", K.IMPORT_EVENT_CODES, drop_deleted=True)


def scoped_imports(ctx: ReportContext) -> DataFrame:
    """Import shipments of the run's invoices and clients."""
    def build() -> DataFrame:
        isf = ctx.in_invoice_scope(ctx.views.import_shipment_fact, "invoice_number")
        importers = ctx.scoped_clients.select("client_key")
        return isf.join(importers, isf.importer_key == importers.client_key, "left_semi")
    return ctx.memo("scoped_imports", build)


def import_shipments(ctx: ReportContext, attributes: bool = False, lists: bool = False) -> DataFrame:
    """Scoped import shipments joined to their role-playing dimensions, and to the
    attributes of their invoice and the containers of their house bill if asked; the
    small dimensions come last."""
    rows = scoped_imports(ctx)
    if lists:
        found = containers(ctx).select(F.col("ei_file_number").alias("found_bill"), F.struct(*CONTAINER_COLUMNS).alias("lists"))
        rows = rows.join(found, rows.housebill_ref == found.found_bill, "left").drop("found_bill")
    rows = ctx.with_parties(rows, ROLES)
    if attributes:
        rows = with_attributes(ctx, rows, "invoice_number")
    return (ctx.with_places(rows, ROLES).join(ctx.service_levels, "service_level_key")
            .join(ctx.service_types, "service_type_key", "left"))


def import_leg(ctx: ReportContext) -> DataFrame:
    """R2: the import leg, grouped by invoice number with ``MAX`` semantics.

    References and events are reduced to one row per invoice before the join
    (exact, since every use is a ``MAX``), so nothing is multiplied.
    """
    return ctx.memo("import_leg", lambda: _import_leg(ctx))


def import_leg_with_containers(ctx: ReportContext) -> DataFrame:
    """The import leg with the container columns of its rows' house bills.

    Shipments meet the containers of their bill while they are narrow, and the lists of
    the greatest bill stay, so the leg's rows need not move to their bill and back."""
    return ctx.memo("import_leg_with_containers", lambda: _import_leg(ctx, lists=True))


def _import_leg(ctx: ReportContext, lists: bool = False) -> DataFrame:
    df = import_shipments(ctx, attributes=True, lists=lists)
    countries = ("po_", "pd_") if ctx.params.port_countries else ("bo_", "bd_")
    code, time = F.max(max_code(IMPORT)), F.max(max_time(IMPORT))
    ic = F.max(reference("IC"))
    return df.groupBy("invoice_number").agg(
        F.max("housebill_ref").alias("ei_file_number"),
        F.max(f"{countries[0]}country_name").alias("origin_branch_country_name"),
        F.max(f"{countries[1]}country_name").alias("destination_branch_country_name"),
        F.max("weight_chargeable").alias("weight_chargeable"),
        F.max("weight_actual").alias("actual_weight"),
        F.max("volume").alias("volume"),
        F.max("bo_branch_code").alias("origin_branch_code"),
        F.max("bd_branch_code").alias("destination_branch_code"),
        R.lane(F.max("bo_branch_code"), F.max("bd_branch_code")).alias("lane"),
        F.max("sh_gci_name").alias("shipper_name"),
        F.max("sh_gci_addr_line1").alias("shipper_address_line_1"),
        F.max("sh_gci_addr_line2").alias("shipper_address_line_2"),
        F.max("sh_gci_state").alias("shipper_state"),
        F.max("sh_gci_city").alias("shipper_city"),
        F.max("cn_gci_name").alias("consignee_name"),
        F.max("cn_gci_addr_line1").alias("consignee_address_line_1"),
        F.max("cn_gci_addr_line2").alias("consignee_address_line_2"),
        F.max("cn_gci_state").alias("consignee_state"),
        F.max("cn_gci_city").alias("consignee_city"),
        F.max("service_level_description").alias("service_level_desc"),
        F.max("dt_act_dep_event_time").alias("departure_event_date_time"),
        F.max("service_type_code").alias("service_type_code"),
        *[max_code_milestone(m, code, time).alias(m.lower()) for m in K.IMPORT_MILESTONES],
        ic.alias("ic"),
        F.max(reference("PO")).alias("po"),
        F.max(reference("MB")).alias("mb"),
        F.max(reference("DP")).alias("dp"),
        R.we_move(ic).alias("we_move"),
        F.max("po_port_code").alias("origin_port_code"),
        F.max("pd_port_code").alias("destination_port_code"),
        F.max("hazard_flag_yn").alias("hazard_flag"),
        F.max("bo_region_code_1").alias("origin_branch_region_code"),
        F.max("bd_region_code_1").alias("destination_branch_region_code"),
        F.max("quantity").alias("qty"),
        F.max(reference("CI")).alias("ci"),
        F.max(reference("EN")).alias("en"),
        *[F.max_by("lists", "housebill_ref")[c].alias(c) for c in CONTAINER_COLUMNS if lists],
    )
