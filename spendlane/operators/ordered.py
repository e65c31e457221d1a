"""Window functions over groups of any size: running count and lead at every row.

A window partitioned by a hot key is one task's work.  Here the rows of a key are
collapsed to its distinct values with their numbers first (combined map-side, and all
peers of a RANGE frame are one row then).  These are laid out by ranges of (key, value)
and written once, so every later step sees the same ranges.  A window inside each
range and an offset per key and range give the number of rows before each value; a
hot key spans as many ranges as its values need.

The layout runs one job when the operator is called; everything after it is lazy.
Nulls sort last in either direction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlane.shared import written

BUCKET = 1 << 16  # rows of a key that one window group holds, and at most as many peers of a list


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


def peers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, value, ``n`` rows with it, ``before``: rows of the key that sort before
    it, and ``known``: rows of the key whose value is not null."""
    spark = df.sparkSession
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = written(
        counted.repartitionByRange(ranges, *keys, F.col(value).asc_nulls_last())
        .withColumn("range", F.spark_partition_id()),
        "ranges")
    # one row for each range that a key lies in
    parts = laid.groupBy("range", *keys).agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0)).alias("named"))
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("range").alias("at"), *[F.col(k).alias(f"key_{k}") for k in keys],
        F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("offset"), F.sum("named").over(of_key).alias("known"))
    in_range = Window.partitionBy("range", *keys).orderBy(F.col(value).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    local = laid.withColumn("local", F.coalesce(F.sum("n").over(in_range), F.lit(0)))
    on = local["range"] == parts["at"]
    for k in keys:
        on = on & local[k].eqNullSafe(parts[f"key_{k}"])
    return local.join(parts, on).select(
        *keys, value, "n", (F.col("offset") + F.col("local")).alias("before"), "known")


def running_count(df: DataFrame, keys: Sequence[str], value: str, out: str, descending: bool = True) -> DataFrame:
    """``df`` with ``COUNT(value) OVER (PARTITION BY keys ORDER BY value)`` at every row,
    in the default frame: all rows up to the current one and its peers."""
    p = peers(df, keys, value)
    up_to = F.col("known") - F.col("before") if descending else F.col("before") + F.col("n")
    counts = p.select(
        *[F.col(c).alias(f"peer_{c}") for c in (*keys, value)],
        F.when(F.col(value).isNull(), F.col("known")).otherwise(up_to).alias(out))
    on = F.lit(True)
    for c in (*keys, value):
        on = on & df[c].eqNullSafe(counts[f"peer_{c}"])
    return df.join(counts, on).select(*[df[c] for c in df.columns], out)


def numbered(df: DataFrame, keys: Sequence[str], value: str, row: str) -> DataFrame:
    """keys, value and ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY value)`` of every row."""
    p = peers(df, keys, value)
    lots = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.lit(BUCKET)))).alias("lot")
    first = F.col("lot") * BUCKET + 1
    rows = F.sequence(first, F.least(first + BUCKET - 1, F.col("n")))
    return p.select("*", lots).select(*keys, value, "before", F.explode(rows).alias(row)).select(
        *keys, value, (F.col("before") + F.col(row)).alias(row))


def leads(df: DataFrame, keys: Sequence[str], value: str, offsets: Sequence[int], row: str = "row") -> DataFrame:
    """keys, value, row number, and ``lead_<k>``: ``LEAD(value, k)`` over the key's rows
    in ascending order, for each offset, at every row.

    Neighbouring rows of a key meet in buckets of :data:`BUCKET`; the first rows of a
    bucket, as many as the largest offset, are also the halo of the one before."""
    widest = max(offsets)
    bucket, place = F.floor((F.col(row) - 1) / BUCKET), (F.col(row) - 1) % BUCKET
    halos = -(-widest // BUCKET)
    goes = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(halos)), lambda j: F.when((j == 0) | (place + j * BUCKET < BUCKET + widest), bucket - j)),
        lambda b: b >= 0)
    spread = numbered(df, keys, value, row).withColumn("_own", bucket).withColumn("_bucket", F.explode(goes))
    w = Window.partitionBy(*keys, "_bucket").orderBy(row)
    named = spread.select("*", *[F.lead(value, k).over(w).alias(f"lead_{k}") for k in offsets])
    return named.where("_own = _bucket").drop("_own", "_bucket")
