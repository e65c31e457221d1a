"""Quirk fixtures for the reusable operators (literal inputs)."""

import datetime as dt

from pyspark.sql import functions as F

from spendlane.operators.joins import left_join_filtered, role
from spendlane.operators.pivots import event_extremes, max_code_milestones, reference_pivot
from spendlane.operators.rollup import first_n_rows, repeated_rollup, running_count_at_first
from spendlane.operators.scope import keep_code_country


def test_max_code_milestone_takes_latest_time_of_any_event(spark):
    ev = spark.createDataFrame(
        [("I1", "FRT", dt.datetime(2020, 1, 1), "N"), ("I1", "ADU", dt.datetime(2020, 1, 9), "N"),
         ("I2", "EDE", dt.datetime(2020, 1, 2), "N"), ("I3", "FRT", dt.datetime(2020, 1, 3), "Y")],
        "invoice_no string, event_code string, event_time timestamp_ntz, deleted_yn string")
    ext = event_extremes(ev, "invoice_no", ("FRT", "ADU", "EDE"), drop_deleted=True)
    out = {r["invoice_no"]: r for r in max_code_milestones(ext, "invoice_no", ("FRT", "ADU")).collect()}
    assert out["I1"]["frt"] == dt.datetime(2020, 1, 9) and out["I1"]["adu"] is None
    # EDE is the greatest code but has no milestone column: everything null
    assert out["I2"]["frt"] is None and out["I2"]["adu"] is None
    # deleted events are dropped before the reduction
    assert "I3" not in out


def test_reference_pivot_one_row_per_key(spark):
    refs = spark.createDataFrame(
        [("I1", "IC", "R1"), ("I1", "IC", "R9"), ("I1", "PO", "R2"), ("I1", "ZZ", "R3")],
        "invoice_no string, reference_type string, reference_no string")
    rows = reference_pivot(refs, "invoice_no", ("IC", "PO", "MB")).collect()
    assert len(rows) == 1
    assert (rows[0]["ref_ic"], rows[0]["ref_po"], rows[0]["ref_mb"]) == ("R9", "R2", None)


def test_running_count_at_first_row(spark):
    df = spark.createDataFrame([("m", "a"), ("m", "a"), ("m", "b"), ("m", None), ("n", None)],
                               "movement_id string, v string")
    out = dict(running_count_at_first(df, ["movement_id"], "v", "n").collect())
    assert out == {"m": 3, "n": 0}


def test_first_n_rows_orders_nulls_last(spark):
    df = spark.createDataFrame([("m", None), ("m", "b"), ("m", "a")], "movement_id string, v string")
    rows = first_n_rows(df, ["movement_id"], F.col("v").asc_nulls_last(), 2).collect()
    assert sorted(r["v"] for r in rows) == ["a", "b"]


def test_row_versus_group_precedence(spark):
    df = spark.createDataFrame([(1, None), (None, 9)], "a int, b int")
    row_level, group_level = df.agg(F.max(F.coalesce("a", "b")),
                                    F.coalesce(F.max("a"), F.max("b"))).first()
    assert (row_level, group_level) == (9, 1)


def test_code_country_exclusion_drops_nulls(spark):
    df = spark.createDataFrame([("2125", "MX"), ("2125", "US"), ("2125", None)], "c string, k string")
    kept = [r["k"] for r in df.filter(keep_code_country(F.col("c"), F.col("k"))).collect()]
    assert kept == ["US"]


def test_left_join_filtered_keeps_unmatched_left(spark):
    left = spark.createDataFrame([("I1",), ("I2",)], "inv string")
    right = spark.createDataFrame([("I1", "IC"), ("I2", "XX")], "inv string, t string")
    out = left_join_filtered(left, right, "inv", F.col("t") == "IC").orderBy("inv").collect()
    assert [(r["inv"], r["t"]) for r in out] == [("I1", "IC"), ("I2", None)]


def test_role_prefixes_columns(spark):
    dim = spark.createDataFrame([(1, "B1")], "branch_key int, branch_code string")
    assert role(dim, "branch_key", "bo_", ["branch_code"]).columns == ["bo_key", "bo_branch_code"]


def test_repeated_rollup_repeats_before_the_cut(spark):
    df = spark.createDataFrame([(["A", "B"], 2), (["A", "B"], 40), ([f"c{i:02d}" for i in range(31)], 3), ([], 2)],
                               "v array<string>, m long")
    out = [r[0] for r in df.select(repeated_rollup(F.col("v"), F.col("m"))).collect()]
    assert out[0] == "A|A|B|B" and out[1] == "|".join("A" * 31) and out[3] == ""
    assert out[2] == "|".join(f"c{i // 3:02d}" for i in range(31))
