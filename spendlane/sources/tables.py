"""Reading the base tables.

Every table is one parquet dataset under a directory.  Reads are lazy: Catalyst
prunes the columns each plan uses and pushes filters into the parquet scan, so a
view that needs two columns of ``orders`` reads only those two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
