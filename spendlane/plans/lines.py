"""Invoice lines: the report's left side, one row per invoice line, and the report's groups of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.functions import rules as R
from spendlane.operators.scope import keep_code_country
from spendlane.plans.context import ReportContext
from spendlane.sources.named import INVOICE_MONTH

GROUP_KEYS = [
    "invoice_date_time", "invoice_expeditor", "invoice_expeditor_line", "billing_code",
    "billing_line_description", "internal_reference", "invoice_date",
]
# attributes of a line's dimension rows; what follows from a group key alone (ship
# mode, charge type, calendar labels of the invoice time and date) is computed per group
LINE_MAXED = [
    "billing_client_id", "billing_client_name", "gci_and_billing_client_name",
    "billing_currency", "billing_branch_code", "customer_invoice_type",
    "billing_master_client_number", "billing_master_client_name", "invoice_year",
    "invoice_month", "billing_branch_country_name", "billing_client_usage_distinction_type",
    "f2f_flag",
]
CLIENT = "billing_client_key"
REFERENCE = "line_reference"
RATE = "decimal(9,4)"


# the order of a line's joins where the small dimensions' texts are wanted, and where not
TEXTS_LAST = ("billing", "clients", "dates", "rates", "currencies", "branches")
FILTERS_FIRST = ("dates", "rates", "currencies", "billing", "branches", "clients")


def enriched_lines(ctx: ReportContext, texts: bool = True) -> DataFrame:
    """Invoice lines joined to their six dimensions and scoped by client,
    date and (optionally) invoice, *before* the code/country exclusion.

    Lines move for the two large dimensions only, billing codes and clients, and while
    they are narrow: a scope comes first, then codes, then the clients' texts; the small
    dimensions are broadcast and add their texts last. If no such ``texts`` are wanted, they
    come first, so that their keys do not travel."""
    cif = ctx.in_invoice_scope(ctx.views.customer_invoice_fact, "invoice_number")
    dates = ctx.dates
    on_date = cif.dt_invoice_date_key == dates.date_key
    if INVOICE_MONTH in cif.columns and INVOICE_MONTH in dates.columns:
        # stored by month: the dates in scope prune the fact's partitions
        on_date = on_date & (cif[INVOICE_MONTH] == dates[INVOICE_MONTH])
    rates, clients = ctx.rates, ctx.scoped_clients
    joins = {
        "billing": (ctx.billing, cif.billing_key == ctx.billing.billing_key),
        "clients": (clients, cif.billing_client_key == clients.client_key),
        "dates": (dates, on_date),
        "rates": (rates, (rates.date_month_key == cif.dt_revenue_month_key) & (rates.currency_key == cif.billing_currency_key)),
        "currencies": (ctx.currencies, cif.billing_currency_key == ctx.currencies.currency_key),
        "branches": (ctx.branches, cif.billing_branch_key == ctx.branches.branch_key),
    }
    scoped = [*["dates"] * ctx.scopes_dates, *["clients"] * ctx.scopes_clients]
    df = cif
    for name in (*scoped, *[n for n in (TEXTS_LAST if texts else FILTERS_FIRST) if n not in scoped]):
        df = df.join(*joins[name])
    return df


def line_columns(ctx: ReportContext, df: DataFrame) -> DataFrame:
    desc = F.col("billing_line_description")
    usage = F.col("usage_distinction_type")
    f2f = R.f2f_flag(desc, usage)
    return df.select(
        CLIENT,
        F.col("dt_invoice_date").alias("invoice_date_time"),
        F.col("gci").alias("billing_client_id"),
        R.client_label("gci", "gci_name").alias("gci_and_billing_client_name"),
        F.col("gci_name").alias("billing_client_name"),
        F.col("invoice_line_number").alias("invoice_expeditor_line"),
        F.col("invoice_number").alias("invoice_expeditor"),
        F.col("billing_amount"),
        F.col("currency_iso_code").alias("billing_currency"),
        F.col("billing_code"),
        desc,
        F.col("customer_invoice_type"),
        F.col("internal_reference"),
        F.col("average_exchange_rate").alias("usd_average_exchange_rate"),
        F.col("master_client_number").alias("billing_master_client_number"),
        F.col("master_client_name").alias("billing_master_client_name"),
        F.col("branch_code").alias("billing_branch_code"),
        F.col("date_year_key").alias("invoice_year"),
        F.col("date_month_name").alias("invoice_month"),
        F.col("date").alias("invoice_date"),
        F.col("country_name").alias("billing_branch_country_name"),
        R.ship_mode("internal_reference").alias("ship_mode"),
        usage.alias("billing_client_usage_distinction_type"),
        R.usd_amount("billing_amount", "average_exchange_rate").alias("billing_amount_usd"),
        f2f.alias("f2f_flag"),
        R.bill_to_flag_line(f2f, usage).alias("bill_to_customer_flag"),
        R.charge_type("billing_code", desc, merged=ctx.params.merged_charges).alias("charge_type"),
        F.month("date").alias("invoice_month_number"),
    )


def invoice_lines(ctx: ReportContext) -> DataFrame:
    """R1: scoped invoice lines with classification and USD amounts."""
    return keyed_lines(ctx).drop(CLIENT)


def keyed_lines(ctx: ReportContext, texts: bool = True) -> DataFrame:
    """:func:`invoice_lines` with the key of their client, by which they lie."""
    return ctx.memo(f"keyed_lines_{texts}", lambda: _keyed_lines(ctx, texts))


def _keyed_lines(ctx: ReportContext, texts: bool) -> DataFrame:
    df = enriched_lines(ctx, texts)
    df = df.filter(keep_code_country(F.col("billing_code"), F.col("country_code")))
    return line_columns(ctx, df)


def lines_per_group(ctx: ReportContext, texts: bool = True) -> DataFrame:
    """Invoice lines aggregated on the seven report keys (no leg columns), by
    :data:`REFERENCE`, the invoice of the legs that they meet.

    Lines are first summed up client by client, where they lie for their clients: that
    takes no shuffle of its own, unless the clients were broadcast or adaptive execution has
    split the lines of one, and then tasks combine their lines to one partial state per
    group (rows, sums, maxima) before it.  So a group that holds a third of all lines reaches
    its reducer as one row per task.  The states move once more, to their reference.
    ``texts``: whether the report wants any of :data:`LINE_MAXED`."""
    df = keyed_lines(ctx, texts)
    if ctx.scopes_invoices and ctx.params.scope_final:
        df = ctx.in_invoice_scope(df, "invoice_expeditor")
    states = df.groupBy(CLIENT, *GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("q_rows"),
        F.sum("billing_amount").alias("q_sum_amount"),
        F.max("billing_amount").alias("q_max_amount"),
        F.sum("billing_amount_usd").alias("q_sum_amount_usd"),
        F.max("billing_amount_usd").alias("q_max_amount_usd"),
        F.sum("usd_average_exchange_rate").alias("rates"),
        F.count("usd_average_exchange_rate").alias("n_rates"),
        *[F.max(c).alias(c) for c in LINE_MAXED],
    )
    # a line without a reference meets nothing: it gets a key of its own, so such
    # lines spread over all tasks instead of meeting in one
    own = F.concat(F.lit("\0"), F.xxhash64("invoice_expeditor", "invoice_expeditor_line", "billing_code").cast("string"))
    states = states.withColumn(REFERENCE, F.coalesce("internal_reference", own)).repartition(REFERENCE)
    average = F.sum("rates").cast("decimal(19,4)") / F.sum("n_rates")  # to 8 digits, as avg(rate)
    return states.groupBy(REFERENCE, *GROUP_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("q_rows", "q_sum_amount", "q_sum_amount_usd")],
        *[F.max(c).alias(c) for c in ("q_max_amount", "q_max_amount_usd", *LINE_MAXED)],
        average.cast("decimal(13,8)").cast(RATE).alias("usd_average_exchange_rate"),
    )
