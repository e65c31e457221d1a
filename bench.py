"""Benchmark the headline queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``; per query one warm-up and the median of
``$BENCH_RUNS`` (default 3) timed runs, each building the DataFrame and
forcing every column through the ``noop`` sink.  Views are derived inside each
query, so a figure holds everything from the given tables on.  ``stored`` repeats some
over views written beforehand, outside the timing and the sum: the report's own cost.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendlane.plans.context import ReportContext  # noqa: E402
from spendlane.plans.export_leg import export_leg  # noqa: E402
from spendlane.plans.import_leg import import_leg  # noqa: E402
from spendlane.plans.report import spend_report  # noqa: E402
from spendlane.registry import QUERIES, WHOLE  # noqa: E402
from spendlane.session import local_session  # noqa: E402
from spendlane.sources.named import write_views  # noqa: E402
from spendlane.sources.views import Views  # noqa: E402

HEADLINE = (
    "invoice_lines", "import_leg", "export_leg", "containers",
    "spend_report", "spend_report_port_country",
)


STORED = {"import_leg": import_leg, "export_leg": export_leg, "spend_report": spend_report}


def _run(build) -> float:
    t = time.perf_counter()
    df = build()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def _median(build, runs: int) -> float:
    _run(build)  # warm-up
    return round(statistics.median(_run(build) for _ in range(runs)), 3)


def _stored(spark, sf_dir: str, runs: int) -> dict[str, float]:
    with tempfile.TemporaryDirectory() as folder:
        views = write_views(Views(spark, sf_dir), f"{folder}/views", by_month=True)
        return {name: _median(lambda fn=fn: fn(ReportContext(views, WHOLE)), runs) for name, fn in STORED.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = tuple(names.split(",")) if names else HEADLINE
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus))))
    spark = local_session(cpus, shuffle_partitions=partitions, app="spendlane-bench")
    results = {}
    for name in names:
        results[name] = _median(lambda name=name: QUERIES[name].build(spark, sf_dir), runs)
    stored = _stored(spark, sf_dir, runs) if os.environ.get("BENCH_STORED", "1") == "1" else {}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "stored": stored,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "spark": spark.version,
        "cores": cpus,
        "shuffle_partitions": partitions,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
