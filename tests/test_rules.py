"""Rule tables: one row per branch of every row-level rule."""

import datetime as dt

from pyspark.sql import functions as F

from spendlane.functions import rules as R


def _eval(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_ship_mode_every_prefix(spark):
    refs = ["J1", "H1", "11", "21", "31", "41", "51", "61", "71", "81", "91", "X1", "", None]
    out = _eval(spark, [(r,) for r in refs], "ref string", R.ship_mode("ref"))
    assert out == ["Truck", "Truck", "Truck", "Air", "Air", "Air", "Ocean", "Ocean", "Ocean",
                   "Truck", "Distribution", "Other", "Other", "Other"]


def test_charge_type_rules(spark):
    rows = [("2102", None), ("P/UT", None), ("2101", None), ("2100", "K84"), ("2100", "k84"),
            ("2100", None), ("4003", None), ("0130", None), ("2115", None), ("2118", None),
            ("2190", None), ("ZZZZ", None), (None, None)]
    schema = "code string, descr string"
    canonical = _eval(spark, rows, schema, R.charge_type("code", "descr"))
    assert canonical == ["Freight", "Freight", "Duty", "Duty", "Customs", "Customs", "Customs",
                         "Delivery", "Destination Charges", "Origin Fees", "Other", "Other",
                         "Other"]
    merged = _eval(spark, rows, schema, R.charge_type("code", "descr", merged=True))
    assert merged[7] == merged[8] == "Destination & Delivery Charges"
    assert merged[:7] == canonical[:7] and merged[9:] == canonical[9:]


def test_f2f_flag_nulls_are_no_match(spark):
    rows = [("FEE, F2F", "STD"), ("FOREIGN TO FOREIGN", None), ("x", "F2FC"), ("x", "f2f"),
            (None, None), ("f2f", "STD")]
    out = _eval(spark, rows, "d string, u string", R.f2f_flag("d", "u"))
    assert out == ["Y", "Y", "Y", "N", "N", "N"]


def test_bill_to_line_versus_final(spark):
    # F2F flag Y with usage F2FC, F2F, null: line rule Y, N, Y; final rule Y, N, N
    rows = [("Y", "F2FC"), ("Y", "F2F"), ("Y", None), ("N", None)]
    schema = "f string, u string"
    assert _eval(spark, rows, schema, R.bill_to_flag_line("f", "u")) == ["Y", "N", "Y", "Y"]
    assert _eval(spark, rows, schema, R.bill_to_flag_final("f", "u")) == ["Y", "N", "N", "Y"]


def test_sanitise_and_strip_quotes(spark):
    rows = [('FEE, F2F "X"',), ('"Unit, 3"',), (None,)]
    assert _eval(spark, rows, "t string", R.sanitise("t")) == ["FEE  F2F X", "Unit  3", None]
    assert _eval(spark, rows, "t string", R.strip_quotes("t")) == ["FEE, F2F X", "Unit, 3", None]


def test_month_and_quarter_labels(spark):
    days = [dt.datetime(2020, m, 1) for m in range(1, 13)] + [None]
    months = _eval(spark, [(d,) for d in days], "t timestamp_ntz", R.month_label("t"))
    assert months[8] == "09-Sept" and months[0] == "01-Jan" and months[11] == "12-Dec"
    assert months[-1] is None
    quarters = _eval(spark, [(d,) for d in days], "t timestamp_ntz", R.quarter_label("t"))
    assert quarters[:4] == ["Q1", "Q1", "Q1", "Q2"] and quarters[-1] is None


def test_month_label_null_inside_aggregate(spark):
    # a literal-array lookup gives the last element for a null index inside an
    # aggregate on Spark 4.1; the CASE lookup must stay null
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2020, 3, 1))], "g int, t timestamp_ntz")
    out = dict(df.groupBy("g").agg(F.max(R.month_label("t")).alias("m")).collect())
    assert out == {1: None, 2: "03-Mar"}


def test_lane_and_label_propagate_null(spark):
    rows = [("B1", "B2"), ("B1", None)]
    assert _eval(spark, rows, "a string, b string", R.lane("a", "b")) == ["B1-B2", None]
    assert _eval(spark, rows, "a string, b string", R.client_label("a", "b")) == ["B1 - B2", None]


def test_we_move(spark):
    assert _eval(spark, [("R1",), (None,)], "ic string", R.we_move("ic")) == ["Y", "N"]


EVERY_CODE = {
    "Freight": ["2102", "2123", "2130", "4000", "4001", "4002", "4004", "4030", "4402", "4408", "4421", "4422", "4469",
                "4506", "4701", "4709", "AMSA", "P/UT"],
    "Duty": ["2101"],
    "Customs": ["0201", "0701", "2100", "4003", "4592"],
    "Delivery": ["0130", "0131", "2106", "4401", "4403", "4423", "4429", "4480", "V093"],
    "Destination Charges": ["2115", "4007", "4024", "4597", "4643", "4645", "V163", "V192", "V197"],
    "Origin Fees": ["2118", "4018", "4031", "4083", "4087", "4461", "4462", "4463", "4703", "4708", "4754", "V196"],
    "Other": ["2190", "4590", "V098", "Z408"],
}


def test_every_charge_code(spark):
    rows = [(c, None) for codes in EVERY_CODE.values() for c in codes]
    assert len(rows) == 58
    kinds = [k for k, codes in EVERY_CODE.items() for _ in codes]
    schema = "code string, descr string"
    assert _eval(spark, rows, schema, R.charge_type("code", "descr")) == kinds
    merged = ["Destination & Delivery Charges" if k in ("Delivery", "Destination Charges") else k for k in kinds]
    assert _eval(spark, rows, schema, R.charge_type("code", "descr", merged=True)) == merged


def test_every_milestone_code(spark):
    """Alone on an invoice, a code sets its own milestone and no other."""
    from spendlane.functions import constants as K
    from spendlane.operators.pivots import event_extremes, max_code_milestones

    joined = {"import": ("FRT", "ADU", "COB", "FND", "ADD", "AFD", "DLV", "BKD", "EDA", "EDI", "EDE", "EDS"),
              "export": ("EDI", "EDA", "EDS")}
    shown = {"import": ("FRT", "POD", "ADU", "FND", "ADD", "AFD", "DLV", "COB", "BKD", "EDA", "EDI", "EDS"),
             "export": ("EDA", "EDI", "EDS")}
    sides = {"import": (K.IMPORT_EVENT_CODES, K.IMPORT_MILESTONES, True), "export": (K.EXPORT_EVENT_CODES, K.EXPORT_MILESTONES, False)}
    at = dt.datetime(2020, 5, 6)
    every = sorted({*joined["import"], "POD", "XXX"})
    for side, (codes, milestones, live) in sides.items():
        rows = [(c, c, at, d) for c in every for d in "NY"] if not live else [(c, c, at, "N") for c in every] + [("gone", "FRT", at, "Y")]
        events = spark.createDataFrame(rows, "invoice_no string, event_code string, event_time timestamp_ntz, deleted_yn string")
        out = max_code_milestones(event_extremes(events, "invoice_no", codes, live), "invoice_no", milestones).collect()
        assert {r.invoice_no for r in out} == set(joined[side])
        for r in out:
            assert {m for m in shown[side] if r[m.lower()] is not None} == {r.invoice_no} & set(shown[side])
            assert set(r.asDict()) == {"invoice_no", *[m.lower() for m in shown[side]]}


def test_published_names():
    from spendlane.functions.published import PUBLISHED_NAMES
    from spendlane.plans.report import REPORT_COLUMNS

    assert list(PUBLISHED_NAMES) == REPORT_COLUMNS and len(set(PUBLISHED_NAMES.values())) == 76
    names = list(PUBLISHED_NAMES.values())
    assert names[:7] == ["Invoice Date Time", "INVOICE EXPEDITOR", "INVOICE EXPEDITOR LINE", "Billing Line Description",
                         "Internal Reference", "Billing Code", "Invoice Date"]
    assert names[52:55] == ["Month", "QUARTER", "YEAR"] and names[-5:] == [
        "QTY", "EN Reference", "CI Reference", "MB Reference", "DP Reference"]
