"""Named views: catalog tables and folders instead of derived views."""

import pytest

from spendlane.params import ReportParams
from spendlane.plans import report as RP
from spendlane.plans.context import ReportContext
from spendlane.sources.named import TableViews, write_views
from spendlane.sources.views import VIEW_NAMES, Views


def test_report_on_catalog_tables(spark, sf_dir):
    derived = Views(spark, sf_dir)
    names = {}
    for i, n in enumerate(VIEW_NAMES):
        names[n] = f"warehouse_view_{i}" if i % 2 else n
        derived.get(n).createOrReplaceTempView(names[n])
    views = TableViews(spark, {k: v for k, v in names.items() if k != v})
    try:
        got = RP.spend_report(ReportContext(views, ReportParams()))
        want = RP.spend_report(ReportContext(derived, ReportParams()))
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    finally:
        for n in names.values():
            spark.catalog.dropTempView(n)


def test_unknown_views_are_errors(spark):
    with pytest.raises(KeyError):
        TableViews(spark, {"no_such_view": "x"})
    with pytest.raises(KeyError):
        TableViews(spark).get("no_such_view")
    with pytest.raises(AttributeError):
        TableViews(spark).no_such_view  # noqa: B018


def test_writing_views_reuses_nothing(spark, sf_dir, tmp_path):
    root = str(tmp_path / "views")
    views = write_views(Views(spark, sf_dir), root)
    for n in ("date_dimension", "event", "shipment_fact"):
        a, b = views.get(n), Views(spark, sf_dir).get(n)
        assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    with pytest.raises(Exception, match="exist"):
        write_views(Views(spark, sf_dir), root)
