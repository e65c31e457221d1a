"""Row-level business rules as pure ``Column -> Column`` functions.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlane.functions import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ship_mode(internal_reference: Column | str) -> Column:
    """Ship mode from the first character of the internal reference.

    Unknown prefixes and null references are ``Other``.
    """
    first = F.substring(_col(internal_reference), 1, 1)
    expr = None
    for prefix, mode in K.SHIP_MODE_BY_PREFIX:
        cond = first == F.lit(prefix)
        expr = F.when(cond, mode) if expr is None else expr.when(cond, mode)
    return expr.otherwise(K.SHIP_MODE_OTHER)


def charge_type(billing_code: Column | str, description: Column | str,
                merged: bool = False) -> Column:
    """Charge category of a billing code; the first matching rule wins.

    ``merged=True`` is the variant rule set in which delivery and destination
    codes form one ``Destination & Delivery Charges`` category.
    """
    code, desc = _col(billing_code), _col(description)
    expr = (
        F.when(code.isin(*K.FREIGHT_CODES), K.FREIGHT)
        .when(code.isin(*K.DUTY_CODES), K.DUTY)
        .when((code == K.DUTY_SPECIAL_CODE) & (desc == K.DUTY_SPECIAL_DESCRIPTION), K.DUTY)
        .when(code.isin(*K.CUSTOMS_CODES), K.CUSTOMS)
    )
    if merged:
        expr = expr.when(code.isin(*(K.DESTINATION_CODES + K.DELIVERY_CODES)),
                         K.DESTINATION_AND_DELIVERY)
    else:
        expr = (expr.when(code.isin(*K.DELIVERY_CODES), K.DELIVERY)
                .when(code.isin(*K.DESTINATION_CODES), K.DESTINATION))
    return (expr.when(code.isin(*K.ORIGIN_FEE_CODES), K.ORIGIN_FEES)
            .when(code.isin(*K.OTHER_CODES), K.OTHER)
            .otherwise(K.OTHER))


def f2f_flag(description: Column | str, usage_type: Column | str) -> Column:
    """``Y`` when the line text marks foreign-to-foreign, or the client usage
    type starts with ``F2F``; null inputs count as no match."""
    desc, usage = _col(description), _col(usage_type)
    hit = F.lit(False)
    for marker in K.F2F_DESCRIPTION_MARKERS:
        hit = hit | F.coalesce(desc.contains(marker), F.lit(False))
    hit = hit | F.coalesce(usage.startswith(K.F2F_USAGE_PREFIX), F.lit(False))
    return F.when(hit, "Y").otherwise("N")


def bill_to_flag_line(f2f: Column | str, usage_type: Column | str) -> Column:
    """Line-level bill-to flag: ``N`` for F2F lines unless usage is ``F2FC``.

    A null usage type makes the inequality unknown, so the line is ``Y``.
    """
    cond = (_col(f2f) == "Y") & (_col(usage_type) != K.F2F_CUSTOMER_USAGE)
    return F.when(cond, "N").otherwise("Y")


def bill_to_flag_final(f2f: Column | str, usage_type: Column | str) -> Column:
    """Report-level bill-to flag: a null usage type counts as empty text, so
    an F2F line with no usage type is ``N``."""
    usage = F.coalesce(_col(usage_type), F.lit(""))
    cond = (_col(f2f) == "Y") & (usage != K.F2F_CUSTOMER_USAGE)
    return F.when(cond, "N").otherwise("Y")


def strip_quotes(text: Column | str) -> Column:
    """Remove double quotes (names in the delimited export)."""
    return F.replace(_col(text), F.lit(K.QUOTE), F.lit(""))


def sanitise(text: Column | str) -> Column:
    """Remove double quotes, then turn commas into blanks."""
    return F.replace(strip_quotes(text), F.lit(K.COMMA), F.lit(" "))


def lookup(index: Column, values: tuple[str, ...], start: int = 1) -> Column:
    """``values[index - start]`` as a CASE chain; out of range or null gives null.

    (A CASE rather than ``element_at`` on a literal array: inside an aggregate,
    Spark 4.1 evaluates ``element_at(array, NULL)`` to the last element.)
    """
    expr = None
    for i, v in enumerate(values, start=start):
        expr = F.when(index == i, v) if expr is None else expr.when(index == i, v)
    return expr


def month_label(ts: Column | str) -> Column:
    """``01-Jan`` .. ``12-Dec`` label of a date or timestamp; null stays null."""
    return lookup(F.month(_col(ts)), K.MONTH_LABELS)


def quarter_label(ts: Column | str) -> Column:
    """``Q1`` .. ``Q4``; null stays null (concat propagates null)."""
    return F.concat(F.lit("Q"), F.quarter(_col(ts)).cast("string"))


def lane(origin_code: Column | str, destination_code: Column | str) -> Column:
    """``origin-destination``; null if either side is null."""
    return F.concat(_col(origin_code), F.lit("-"), _col(destination_code))


def client_label(gci: Column | str, name: Column | str) -> Column:
    """``GCI - name``; null if either part is null."""
    return F.concat(_col(gci), F.lit(" - "), _col(name))


def we_move(ic_reference: Column | str) -> Column:
    """``Y`` when the shipment carries an IC reference, else ``N``."""
    return F.when(_col(ic_reference).isNull(), "N").otherwise("Y")


def usd_amount(amount: Column | str, rate: Column | str) -> Column:
    """Billing amount converted with the monthly average rate (exact decimal)."""
    return _col(amount) * _col(rate)
