"""Plan shape: what the report must (not) contain at any scale."""

import contextlib
import io
import os

import pytest

from spendlane.plans import containers as C
from spendlane.plans import report as RP
from spendlane.plans.context import ReportContext
from spendlane.registry import MASTER_SCOPE, QUERIES, WHOLE


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _executed(df) -> str:
    """The final adaptive plan, after a run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def ctx(spark, sf_dir):
    return ReportContext.from_dir(spark, sf_dir, WHOLE)


def test_report_has_no_cartesian_or_nested_loop_join(ctx):
    plan = _plan(RP.spend_report(ctx))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_container_rollup_is_limited_before_its_shuffle(ctx):
    plan = _plan(C.containers(ctx))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_client_filter_reaches_the_scan_of_a_named_view(spark, sf_dir, tmp_path):
    from spendlane.plans import lines as L
    from spendlane.sources.named import write_views
    from spendlane.sources.views import Views

    views = write_views(Views(spark, sf_dir), str(tmp_path / "views"))
    plan = _plan(L.invoice_lines(ReportContext(views, MASTER_SCOPE)))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "master_client_number#" in line]
    assert scans
    # the lines read client names and segments, never the party addresses
    assert all("gci_addr_line1" not in line and "gci_city" not in line for line in scans)
    assert any("PushedFilters: [In(master_client_number" in line for line in scans)


def test_tall_tables_are_reduced_once(spark, sf_dir, tmp_path):
    """References and events are scanned once by a report that uses them in two legs."""
    from spendlane.sources.named import write_views
    from spendlane.sources.views import Views

    views = write_views(Views(spark, sf_dir), str(tmp_path / "views"))
    plan = _executed(RP.spend_report(ReportContext(views, WHOLE)))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    for column in ("reference_no#", "event_code#"):
        assert sum(column in line for line in scans) == 1, column


def test_building_a_query_runs_no_job_and_writes_nothing(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "queries")
    try:
        for name, q in QUERIES.items():
            if name not in ("lead_offsets", "running_count"):  # these lay out ranges when built
                q.build(spark, sf_dir)
        jobs = tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    # Spark reads the footer of a parquet file in a job of its own; nothing else runs
    stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert all(tracker.getStageInfo(s).numTasks == 1 for s in stages if tracker.getStageInfo(s))
    assert os.listdir(tmp_path) == []
