"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlane import shared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Rows reach the Python tasks in Arrow batches of a bounded size: texts are
    long, and Spark's own bound counts rows.  Set for the session by every operator
    that runs Python over texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def doc_texts(docs: DataFrame, also: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` only (and ``also``), so extra columns can clash with nothing;
    a null text is the empty text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *([F.col(also)] if also else []),
    )


def id_remainder(column: Column, divisor: int) -> Column:
    """``crc32(id as text) mod divisor``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back: cuts
    lineage, and a lost executor loses nothing of it."""
    return shared.written(df, name, compression="zstd")


def per_batch(make, schema: pa.Schema):
    """A ``mapInArrow`` function from ``make() -> (RecordBatch -> dict of
    columns)``; ``make`` runs once per task, where a task has caches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(one(batch), schema=schema)

    return run


def utf8_buffers(column: pa.Array):
    """(bytes as a numpy array, offsets) of a non-null string column, without a copy
    of the text."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets
