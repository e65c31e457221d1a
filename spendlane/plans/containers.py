"""Ocean container roll-up: one row per scoped Ocean movement (R6).

The report joins shipment rows to container records, so a movement with ``m``
shipment rows lists and counts each of its records ``m`` times.  Here both
sides are reduced to one row per movement first, and ``m`` is applied to the
reduced values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.functions import constants as K
from spendlane.operators.ordered import leads, running_count
from spendlane.operators.rollup import first_n_rows, repeated_rollup, running_count_at_first
from spendlane.plans.context import ReportContext
from spendlane.plans.export_leg import of_wanted, scoped_shipments

NUMBER, TYPE = "container_number", "container_type"
CONTAINER_COLUMNS = ("container_count", "containers", "container_sizes")


def ocean_movements(ctx: ReportContext) -> DataFrame:
    """One row for each scoped shipment row whose ship mode is Ocean."""
    def build() -> DataFrame:
        modes = F.broadcast(ctx.views.ship_mode_dimension.filter(F.col("ship_mode_desc") == K.OCEAN))
        return scoped_shipments(ctx).join(modes, "ship_mode_key").select("movement_id")
    return ctx.memo("ocean_movements", build)


def movement_rows(ctx: ReportContext) -> DataFrame:
    """movement_id and ``shipment_rows``, how many rows it has above."""
    def build() -> DataFrame:
        return ocean_movements(ctx).groupBy("movement_id").agg(F.count(F.lit(1)).alias("shipment_rows"))
    return ctx.memo("movement_rows", build)


def container_rows(ctx: ReportContext) -> DataFrame:
    """Container records with a known move type, with number and type.

    The move-type join contributes no column; it keeps only containers whose
    move type exists.
    """
    def build() -> DataFrame:
        v = ctx.views
        return (of_wanted(ctx, v.container_shipment_fact)
                .join(F.broadcast(v.move_type_dimension), "move_type_key")
                .join(F.broadcast(v.container_type_dimension), "container_type_key")
                .select("movement_id", NUMBER, TYPE))
    return ctx.memo("container_rows", build)


def first_rows(ctx: ReportContext, n: int, rank_col: str = "_rank") -> DataFrame:
    """The first ``n`` joined rows per scoped Ocean movement, ascending by
    number with nulls last: records are ranked and limited before the join,
    then each stands for as many rows as the movement has shipment rows."""
    ranked = first_n_rows(container_rows(ctx), ["movement_id"], F.col(NUMBER).asc_nulls_last(), n, "_own")
    joined = ranked.join(movement_rows(ctx), "movement_id")
    before = (F.col("_own") - 1) * F.col("shipment_rows")
    last = F.least(before + F.col("shipment_rows"), F.lit(n))
    places = F.when(before < n, F.sequence((before + 1).cast("int"), last.cast("int")))
    return joined.withColumn(rank_col, F.explode(places)).drop("_own", "shipment_rows")


def container_joins(ctx: ReportContext) -> DataFrame:
    """movement_id, number and type of every joined row: each record once for each
    shipment row of its movement."""
    return ocean_movements(ctx).join(container_rows(ctx), "movement_id")


def running_counts(ctx: ReportContext) -> DataFrame:
    """Every joined row with the running count of numbers, from the greatest number
    down, rows of one number together."""
    rows = container_joins(ctx).select("movement_id", NUMBER)
    return running_count(rows, ["movement_id"], NUMBER, "container_count")


def number_leads(ctx: ReportContext, offsets: tuple[int, ...]) -> DataFrame:
    """Every joined row with its place among its movement's numbers and the numbers
    that follow it at the offsets."""
    return leads(container_joins(ctx), ["movement_id"], NUMBER, offsets, row="position")


def first_values(ctx: ReportContext, kind: str) -> DataFrame:
    """Per movement the first 31 non-null numbers, or types, as a sorted list.

    Ranked per movement and limited on both sides of the shuffle, so a list is bounded
    whatever the size of a movement, and lies by movement as the joins need it.
    """
    rows = container_rows(ctx).select("movement_id", kind).filter(F.col(kind).isNotNull())
    top = first_n_rows(rows, ["movement_id"], F.col(kind).asc(), K.ROLLUP_WIDTH)
    return top.groupBy("movement_id").agg(F.array_sort(F.collect_list(kind)).alias(kind))


def containers(ctx: ReportContext) -> DataFrame:
    """R6: per Ocean movement, the first 31 container numbers and the first
    31 container types (each sorted on its own, duplicates kept) as ``|``
    lists, plus the count of non-null container numbers (not capped)."""
    def build() -> DataFrame:
        records = running_count_at_first(container_rows(ctx), ["movement_id"], NUMBER, "_records")
        rows = F.col("shipment_rows")

        def text(kind: str):  # a movement without a value has no list
            return F.when(F.size(kind) > 0, repeated_rollup(F.col(kind), rows))

        return (records.join(movement_rows(ctx), "movement_id")
                .join(first_values(ctx, NUMBER), "movement_id", "left")
                .join(first_values(ctx, TYPE), "movement_id", "left")
                .select(F.col("movement_id").alias("ei_file_number"),
                        text(NUMBER).alias("containers"),
                        (F.col("_records") * rows).alias("container_count"),
                        text(TYPE).alias("container_sizes")))
    return ctx.memo("containers", build)
