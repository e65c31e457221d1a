"""Conditional aggregation over tall attribute tables.

Both operators reduce their tall table to one row per key *before* the report
joins it, so the join never multiplies references by events.  That is exact
because every use downstream is a ``MAX``; the aggregation is map-side
combinable, so a hot key costs one partial row per map task, not a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reference_pivot(refs: DataFrame, key: str, types: tuple[str, ...],
                    type_col: str = "reference_type", value_col: str = "reference_no",
                    prefix: str = "ref_") -> DataFrame:
    """One row per ``key``: ``max(value where type = T)`` for each ``T``.

    Rows of other types are filtered before the shuffle.
    """
    t, v = F.col(type_col), F.col(value_col)
    names = [f"{prefix}{x.lower()}" for x in types]
    # one column per type, computed in a (codegen) projection before the
    # sort-based aggregate folds them
    spread = refs.filter(t.isin(*types)).select(
        key, *[F.when(t == x, v).alias(n) for x, n in zip(types, names)])
    return spread.groupBy(key).agg(*[F.max(n).alias(n) for n in names])


def event_extremes(events: DataFrame, key: str, codes: tuple[str, ...],
                   drop_deleted: bool) -> DataFrame:
    """One row per ``key``: the greatest event code and the latest event time
    among events with a listed code (and not soft-deleted, if asked)."""
    ev = events.filter(F.col("event_code").isin(*codes))
    if drop_deleted:
        ev = ev.filter(F.col("deleted_yn") == "N")
    return ev.groupBy(key).agg(F.max("event_code").alias("max_event_code"),
                               F.max("event_time").alias("max_event_time"))


def max_code_milestone(code: str, max_code: Column | str = "max_event_code",
                       max_time: Column | str = "max_event_time") -> Column:
    """The milestone time for ``code``: set only when ``code`` is the
    alphabetically greatest code of the group, and then it is the latest time of
    *any* listed event of the group (so at most one milestone is non-null)."""
    mc = F.col(max_code) if isinstance(max_code, str) else max_code
    mt = F.col(max_time) if isinstance(max_time, str) else max_time
    return F.when(mc == code, mt)


def max_code_milestones(extremes: DataFrame, key: str, milestones: tuple[str, ...]) -> DataFrame:
    """Milestone columns from :func:`event_extremes` output."""
    return extremes.select(key, *[max_code_milestone(m).alias(m.lower()) for m in milestones])
