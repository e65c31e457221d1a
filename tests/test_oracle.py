"""Every query of the report against its DuckDB oracle (same parquet tables)."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck
from spendlane.registry import QUERIES as REPORT

QUERIES = {n: q for n, q in entry.queries().items() if n in REPORT}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(REPORT) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir, con)
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], (r.get("only_spark"), r.get("only_oracle"))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 76
    assert df.count() > 0


def test_report_without_broadcasts(spark, sf_dir, con):
    """Dimensions too large to broadcast take the sort-merge path; same rows."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        r = compare(QUERIES["spend_report"](spark, sf_dir), ORACLES["spend_report"], sf_dir, con)
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    assert r["values_match"] and r["spark_rows"] == r["oracle_rows"]
