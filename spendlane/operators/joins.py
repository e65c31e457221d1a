"""Join helpers: role-playing dimensions and filtered left joins.

No join is hinted here; the report's context hints the dimensions that a calendar or a
list of codes bounds.  Spark broadcasts a side whose size it knows to be small, and
AQE turns a shuffle join into a broadcast, or splits its skewed partitions, from
the sizes it has measured.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def role(dim: DataFrame, key: str, prefix: str, columns: list[str]) -> DataFrame:
    """One role of a role-playing dimension: the key renamed ``{prefix}key``
    and each attribute renamed ``{prefix}{attribute}``."""
    return dim.select(
        F.col(key).alias(f"{prefix}key"),
        *[F.col(c).alias(f"{prefix}{c}") for c in columns],
    )


def left_join_filtered(left: DataFrame, right: DataFrame, on, predicate) -> DataFrame:
    """Left join whose ON clause carries an extra predicate on the right side.

    Filtering the right side before the join keeps unmatched left rows, which
    a WHERE after the join would drop.
    """
    return left.join(right.filter(predicate), on=on, how="left")


@dataclass(frozen=True)
class Role:
    """A fact's reference to a dimension: attributes come as ``{prefix}{column}``."""

    prefix: str
    dimension: str
    key: str
    fact_key: str
    columns: tuple[str, ...]


def stacked_lookup(facts: DataFrame, roles: Sequence[Role], dim: DataFrame) -> DataFrame:
    """Inner joins of ``facts`` to all ``roles`` of one dimension by one lookup.

    The distinct combinations of the roles' keys become (combination, role, key) rows,
    meet the dimension once, and are folded back to one row per combination, which
    the facts join.  The dimension is read and shuffled once however many roles it
    plays, the wide facts once instead of once per role, and a party that many facts
    name is looked up once.  Keys of the dimension must be unique.
    """
    key, columns = roles[0].key, roles[0].columns
    fact_keys = list(dict.fromkeys(r.fact_key for r in roles))
    combos = facts.select(*[F.col(k).alias(f"of_{k}") for k in fact_keys]).distinct()
    plays = F.array(*[F.struct(F.lit(i).alias("role"), F.col(f"of_{r.fact_key}").alias("key")) for i, r in enumerate(roles)])
    stacked = combos.withColumn("play", F.explode(plays))
    attributes = F.struct(*[F.col(c) for c in columns])
    found = stacked.join(dim.select(F.col(key).alias("found_key"), attributes.alias("found")), F.col("play.key") == F.col("found_key"))
    folded = found.groupBy(*[f"of_{k}" for k in fact_keys]).agg(
        F.array_sort(F.collect_list(F.struct(F.col("play.role").alias("role"), "found"))).alias("all")
    ).filter(F.size("all") == len(roles))
    folded = folded.select(
        *[f"of_{k}" for k in fact_keys],
        *[F.col("all")[i]["found"][c].alias(f"{r.prefix}{c}") for i, r in enumerate(roles) for c in columns])
    on = F.lit(True)
    for k in fact_keys:
        on = on & (facts[k] == folded[f"of_{k}"])
    return facts.join(folded, on).drop(*[f"of_{k}" for k in fact_keys])


def join_roles(facts: DataFrame, roles: Sequence[Role], dimension: Callable[[str], DataFrame],
               stacked: Sequence[str] = ()) -> DataFrame:
    """``facts`` inner-joined to every role, dimension by dimension: a dimension named in
    ``stacked`` by one lookup for all its roles, any other role by role."""
    for name in dict.fromkeys(r.dimension for r in roles):
        mine, dim = [r for r in roles if r.dimension == name], dimension(name)
        if name in stacked:
            facts = stacked_lookup(facts, mine, dim)
            continue
        for r in mine:
            one = role(dim, r.key, r.prefix, list(r.columns))
            facts = facts.join(one, facts[r.fact_key] == one[f"{r.prefix}key"])
    return facts
