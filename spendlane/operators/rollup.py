"""Ordered top-N string roll-up per group and its window primitives.

The report lists the first 31 container numbers (and, separately, container
types) of a movement in ascending order, joined by ``|``.  Instead of 31
``lead`` calls per ordering, the rows are ranked with ``row_number`` and
filtered to rank <= N before being collected.  Catalyst plans that filter as a
``WindowGroupLimit`` on *both* sides of the shuffle, so even a movement holding a
third of all rows ships at most N rows per map task and the collected list is
never longer than N.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlane.functions import constants as K


def first_n_rows(df: DataFrame, keys: list[str], order: Column, n: int,
                 rank_col: str = "_rank") -> DataFrame:
    """Rows ranked 1..n per group by ``order`` (ties broken arbitrarily);
    the rank is kept in ``rank_col``."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def repeated_rollup(values: Column, times: Column, n: int = K.ROLLUP_WIDTH,
                    sep: str = K.ROLLUP_SEPARATOR) -> Column:
    """The roll-up text of an ascending list of at most ``n`` values of which
    each row occurs ``times`` over: every value is repeated (``n`` times at
    most) before the cut at ``n``."""
    each = F.least(times, F.lit(n)).cast("int")
    repeated = F.flatten(F.transform(values, lambda v: F.array_repeat(v, each)))
    return F.array_join(F.slice(repeated, 1, n), sep)


def running_count_at_first(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """``COUNT(v) OVER (PARTITION BY keys ORDER BY v DESC)`` read at the first
    row of the ascending order: the default RANGE frame then spans every
    non-null value, so it is the plain per-group count of non-null values."""
    return df.groupBy(*keys).agg(F.count(value).alias(out))
