"""Tables that one run writes for itself, in the folder all executors share.

The folder is the one that the cluster names in ``spark.checkpoint.dir``; only where it
is unset, as in tests, one below the warehouse is used.  ``clean_up`` removes what a
session has written, once its results have been consumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints").rstrip("/")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once and read back: cuts lineage, fixes what may come out
    differently when computed again, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _tables(spark).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _tables(spark: SparkSession) -> list[str]:
    return _written.setdefault(spark.sparkContext.applicationId, [])


def mark(spark: SparkSession) -> int:
    """How many tables the session has written; for :func:`clean_up`."""
    return len(_tables(spark))


def clean_up(spark: SparkSession, since: int = 0) -> int:
    """Removes the tables this session has written (after ``since``, a :func:`mark`),
    whose results must have been consumed; returns how many."""
    tables = _tables(spark)
    paths, tables[since:] = tables[since:], []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
