"""Scoping predicates: client, invoice date, code/country exclusion, invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlane.functions import constants as K
from spendlane.params import ReportParams


def client_scope_column(params: ReportParams) -> str:
    """The client-dimension column the scope applies to."""
    return "master_client_number" if params.by_master else "gci"


def client_scope(clients: DataFrame, params: ReportParams) -> DataFrame:
    """Clients accepted by the run's client scope; all of them if it has none.

    The column is chosen in Python, so the predicate reaching the scan is a
    plain ``IN`` list that parquet can push down.
    """
    if params.client_ids is None:
        return clients
    return clients.filter(F.col(client_scope_column(params)).isin(*params.client_ids))


def date_scope(df: DataFrame, date_col: str, params: ReportParams) -> DataFrame:
    """Inclusive invoice-date range; an end that is not given is open."""
    if params.start is not None:
        df = df.filter(F.col(date_col) >= F.lit(params.start))
    if params.end is not None:
        df = df.filter(F.col(date_col) <= F.lit(params.end))
    return df


def keep_code_country(code: Column, country_code: Column) -> Column:
    """``code || country != '2125MX'``; a null in either part drops the row."""
    return F.concat(code, country_code) != F.lit(K.EXCLUDED_CODE_COUNTRY)


def invoice_scope(df: DataFrame, col: str, params: ReportParams) -> DataFrame:
    """Restrict to the spot-check invoices, if the run names any."""
    if params.invoice_numbers is None:
        return df
    return df.filter(F.col(col).isin(*params.invoice_numbers))


def table_scope(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``col`` is in ``ids``, a table of one column, of any size:
    a left semi-join.  Repeated and null ids change nothing.

    The comparison holds for every id; it tells the optimiser that the table is a
    selection, so that it builds its runtime filter from it and applies it to the scan.
    """
    name = ids.columns[0]
    chosen = ids.select(F.col(name).cast("string").alias("scope_id")).filter(F.col("scope_id") >= "")
    return df.join(chosen, df[col] == chosen["scope_id"], "left_semi")
