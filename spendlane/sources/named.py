"""Views read from where a warehouse keeps them.

The report asks its views by name only, so it runs unchanged on
:class:`TableViews` (catalog tables), on :class:`ParquetViews` (folders) and on
the derived :class:`spendlane.sources.views.Views`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlane.sources.views import VIEW_NAMES


class NamedViews:
    """The 21 views as attributes; a subclass says how one is read.  A view is
    read when it is first used, and is the same DataFrame afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._frames: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        raise NotImplementedError

    def get(self, name: str) -> DataFrame:
        if name not in VIEW_NAMES:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = self.read(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEW_NAMES:
            return self.get(name)
        raise AttributeError(name)


class TableViews(NamedViews):
    """Catalog tables or views: ``names`` maps a view to its qualified name;
    views that it leaves out are looked up under their own names.  ``bucketed``: the
    facts are stored in buckets as :func:`save_bucketed` does."""

    def __init__(self, spark: SparkSession, names: Mapping[str, str] | None = None, bucketed: bool = False):
        super().__init__(spark)
        self.bucketed = bucketed
        self.names = dict(names or {})
        unknown = set(self.names) - set(VIEW_NAMES)
        if unknown:
            raise KeyError(f"no such views: {sorted(unknown)}")

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.names.get(name, name))


class ParquetViews(NamedViews):
    """One parquet folder for each view below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark)
        self.root = root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


FILES_A_MONTH = 16
INVOICE_MONTH = "invoice_month"  # partition of stored invoice lines: year * 100 + month of the invoice date
MONTH_OF = {"customer_invoice_fact": "dt_invoice_date_key", "date_dimension": "date_key"}
# the keys by which the legs meet their facts; tables bucketed by them are joined where they lie
BUCKETED_BY = {
    "import_shipment_fact": "invoice_number", "reference": "invoice_no", "event": "invoice_no",
    "invoice_movement": "movement_id", "shipment_reference_fact": "movement_id", "shipment_fact": "movement_id",
    "container_shipment_fact": "movement_id",
}


def with_invoice_month(views, name: str) -> DataFrame:
    """The invoice fact or the date dimension with the month of its date.  A line whose
    date the dimension does not know has none, as it meets no date either."""
    df = views.get(name)
    month = (F.year("date") * 100 + F.month("date")).cast("int")
    if name == "date_dimension":
        return df.withColumn(INVOICE_MONTH, month)
    known = views.get("date_dimension").select(F.col("date_key").alias("_key"), month.alias(INVOICE_MONTH)).distinct()
    return df.join(known, df[MONTH_OF[name]] == known["_key"], "left").drop("_key")


def write_views(views, root: str, by_month: bool = False) -> ParquetViews:
    """Writes all views below ``root``, a new folder that driver and executors
    share, and returns readers of it.  Nothing calls this implicitly, and nothing
    is reused: a folder that exists is an error.

    ``by_month`` adds the month of the invoice date to the invoice fact, as its
    partitions, and to the date dimension, so that a date scope reads the months it
    needs only.  Each date key must have one date."""
    for name in VIEW_NAMES:
        if by_month and name in MONTH_OF:
            out = with_invoice_month(views, name)
            if name == "customer_invoice_fact":  # a month's lines in few files, however many tasks hold some
                out = out.repartition(INVOICE_MONTH, F.pmod(F.xxhash64("invoice_number"), F.lit(FILES_A_MONTH)))
                out.write.mode("error").partitionBy(INVOICE_MONTH).parquet(f"{root.rstrip('/')}/{name}")
                continue
        else:
            out = views.get(name)
        out.write.mode("error").parquet(f"{root.rstrip('/')}/{name}")
    return ParquetViews(views.spark, root)


def save_bucketed(views, prefix: str, buckets: int, storage: str = "parquet") -> TableViews:
    """Saves the facts that the legs join as catalog tables ``{prefix}{view}``, bucketed and
    sorted by their join keys (:data:`BUCKETED_BY`), the other views plainly, and returns
    readers of them.  Legs then meet their facts, references and events without moving
    them.  A table that exists is an error."""
    for name in VIEW_NAMES:
        writer = views.get(name).write.mode("error").format(storage)
        if name in BUCKETED_BY:
            writer = writer.bucketBy(buckets, BUCKETED_BY[name]).sortBy(BUCKETED_BY[name])
        writer.saveAsTable(f"{prefix}{name}")
    return TableViews(views.spark, {name: f"{prefix}{name}" for name in VIEW_NAMES}, bucketed=True)
