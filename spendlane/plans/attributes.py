"""References and events of an invoice, reduced once for both legs.

The import leg reads the live events of twelve codes and six reference types, the
export leg all events of three codes and seven types.  Both are conditional
maxima over the same two tall tables, so one aggregation serves both: the tables
are cut to the invoices of the run, stacked, and reduced to one row per invoice
(map-side first, so a hot invoice costs one partial row per task).  The results are
arrays, so both legs use the very same columns and Spark runs the reduction
once and reuses its exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlane.functions import constants as K
from spendlane.plans.context import ReportContext

IMPORT, EXPORT = 0, 1


def reference(kind: str) -> Column:
    """The greatest reference number of a type."""
    return F.col("refs")[K.EXPORT_REFERENCE_TYPES.index(kind)]


def max_code(leg: int) -> Column:
    return F.col("codes")[leg]


def max_time(leg: int) -> Column:
    return F.col("times")[leg]


def _invoices(ctx: ReportContext) -> DataFrame | None:
    """Invoices whose attributes the run reads; None if it is not restricted."""
    from spendlane.plans.export_leg import scoped_movement_invoices
    from spendlane.plans.import_leg import scoped_imports

    if not ctx.scoped:
        return None
    own = scoped_imports(ctx).select(F.col("invoice_number").alias("invoice_no"))
    moved = scoped_movement_invoices(ctx).select(F.col("invoice_number").alias("invoice_no"))
    return ctx.chosen(own.unionByName(moved).distinct())


def invoice_attributes(ctx: ReportContext) -> DataFrame:
    """invoice_no, refs (by ``K.EXPORT_REFERENCE_TYPES``), codes and times (import,
    export), one row for each invoice that has any."""
    return ctx.memo("invoice_attributes", lambda: _invoice_attributes(ctx))


def _tall(ctx: ReportContext) -> tuple[DataFrame, DataFrame, list[str]]:
    """References and events of the run, one column for each maximum, and the names of
    the reference columns."""
    refs, events = ctx.views.reference, ctx.views.event
    if ctx.params.scope_export_references:  # else a movement's other invoices count too
        refs, events = (ctx.in_invoice_scope(t, "invoice_no") for t in (refs, events))
    refs = refs.filter(F.col("reference_type").isin(*K.EXPORT_REFERENCE_TYPES))
    events = events.filter(F.col("event_code").isin(*sorted({*K.IMPORT_EVENT_CODES, *K.EXPORT_EVENT_CODES})))
    names = [f"r{i}" for i in range(len(K.EXPORT_REFERENCE_TYPES))]
    tests = {
        IMPORT: F.col("event_code").isin(*K.IMPORT_EVENT_CODES) & (F.col("deleted_yn") == "N"),
        EXPORT: F.col("event_code").isin(*K.EXPORT_EVENT_CODES),
    }
    wide_refs = refs.select(
        "invoice_no",
        *[F.when(F.col("reference_type") == t, F.col("reference_no")).alias(n)
          for t, n in zip(K.EXPORT_REFERENCE_TYPES, names)])
    wide_events = events.select(
        "invoice_no",
        *[F.when(test, F.col("event_code")).alias(f"c{leg}") for leg, test in tests.items()],
        *[F.when(test, F.col("event_time")).alias(f"t{leg}") for leg, test in tests.items()])
    return wide_refs, wide_events, names


def _greatest(tall: DataFrame) -> DataFrame:
    return tall.groupBy("invoice_no").agg(*[F.max(c).alias(c) for c in tall.columns if c != "invoice_no"])


def _arrays(names: list[str]) -> list[Column]:
    legs = (IMPORT, EXPORT)
    return [F.array(*names).alias("refs"), F.array(*[f"c{leg}" for leg in legs]).alias("codes"),
            F.array(*[f"t{leg}" for leg in legs]).alias("times")]


def _invoice_attributes(ctx: ReportContext) -> DataFrame:
    refs, events, names = _tall(ctx)
    tall = refs.unionByName(events, allowMissingColumns=True)
    invoices = _invoices(ctx)
    if invoices is not None:
        tall = tall.join(invoices, "invoice_no", "left_semi")
    return _greatest(tall).select("invoice_no", *_arrays(names))


def with_attributes(ctx: ReportContext, df: DataFrame, invoice: str) -> DataFrame:
    """``df`` left-joined to the attributes of its invoice.

    Tables that are stored in buckets by invoice are reduced where they lie, each
    on its own: stacking them would move both."""
    if not getattr(ctx.views, "bucketed", False):
        attributes = invoice_attributes(ctx)
        return df.join(attributes, df[invoice] == attributes.invoice_no, "left").drop("invoice_no")
    refs, events, names = _tall(ctx)
    refs = ctx.memo("bucketed_references", lambda: _greatest(refs).withColumnRenamed("invoice_no", "ref_invoice"))
    events = ctx.memo("bucketed_events", lambda: _greatest(events).withColumnRenamed("invoice_no", "event_invoice"))
    met = df.join(refs, df[invoice] == refs.ref_invoice, "left").join(events, df[invoice] == events.event_invoice, "left")
    return met.select(*[df[c] for c in df.columns], *_arrays(names))
