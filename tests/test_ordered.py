"""Windows over hot groups: every row's running count and leads, against plain Python."""

import random

import pytest

from spendlane.operators import ordered as W


def table(spark, rows):
    return spark.createDataFrame(rows, "movement_id string, v string")


def mixed(seed, n=900):
    """Ties, nulls, a null key, and one movement of a third of all rows."""
    rng = random.Random(seed)
    rows = [("hot", None if rng.random() < 0.1 else f"c{rng.randrange(n // 6):04d}") for _ in range(n // 3)]
    rows += [(rng.choice([None, "a", "b", "é", ""]), rng.choice([None, "x", "X", "", "é", f"y{rng.randrange(9)}"])) for _ in range(n // 3)]
    rows += [("same", "tie")] * (n // 3)
    rng.shuffle(rows)
    return rows


def last(v):
    return (v is None, (v or "").encode())


def groups(rows):
    out = {}
    for k, v in rows:
        out.setdefault(k, []).append(v)
    return {k: sorted(v, key=last) for k, v in out.items()}


@pytest.mark.parametrize("descending", (True, False))
def test_running_count_at_every_row(spark, descending):
    rows = mixed(1)
    got = sorted((tuple(r) for r in W.running_count(table(spark, rows), ["movement_id"], "v", "n", descending).collect()), key=repr)
    want = []
    for k, values in groups(rows).items():
        known = [v for v in values if v is not None]
        for v in values:
            up_to = [x for x in known if v is None or (x.encode() >= v.encode() if descending else x.encode() <= v.encode())]
            want.append((k, v, len(up_to)))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("bucket", (1 << 16, 64, 7, 1))
def test_leads_at_every_row(spark, monkeypatch, bucket):
    """Also where a movement spans many buckets and a halo more than one."""
    monkeypatch.setattr(W, "BUCKET", bucket)
    rows = mixed(2, 300)
    offsets = (0, 1, 30)
    got = sorted((tuple(r) for r in W.leads(table(spark, rows), ["movement_id"], "v", offsets).collect()), key=repr)
    want = []
    for k, values in groups(rows).items():
        for i, v in enumerate(values):
            want.append((k, v, i + 1, *[values[i + o] if i + o < len(values) else None for o in offsets]))
    assert got == sorted(want, key=repr)


def test_hot_key_spans_ranges_and_buckets(spark, monkeypatch):
    """A movement of a third of all rows: its values lie in many ranges, none of them
    near the movement's size, and no window group is larger than a bucket and its halo."""
    from pyspark.sql import functions as F

    laid = []
    plain = W.written
    monkeypatch.setattr(W, "written", lambda df, name: laid.append(plain(df, name)) or laid[-1])
    monkeypatch.setattr(W, "BUCKET", 50)
    rows = [("hot", f"c{i:05d}") for i in range(2000)] + [(f"m{i}", "x") for i in range(4000)]
    numbered = W.numbered(table(spark, rows), ["movement_id"], "v", "row")
    per_range = [r[1] for r in laid[0].where("movement_id = 'hot'").groupBy("range").count().collect()]
    assert len(per_range) >= 2 and max(per_range) <= 1500
    sizes = numbered.groupBy("movement_id", F.floor((F.col("row") - 1) / 50)).count().agg(F.max("count")).first()[0]
    assert sizes == 50


def test_ties_are_one_row_before_the_layout(spark, monkeypatch):
    laid = []
    plain = W.written
    monkeypatch.setattr(W, "written", lambda df, name: laid.append(plain(df, name)) or laid[-1])
    got = W.running_count(table(spark, [("m", "t")] * 5000 + [("m", None)]), ["movement_id"], "v", "n")
    assert laid[0].count() == 2
    assert {tuple(r) for r in got.distinct().collect()} == {("m", "t", 5000), ("m", None, 5000)}


def test_empty_table(spark):
    empty = table(spark, [])
    assert W.running_count(empty, ["movement_id"], "v", "n").collect() == []
    assert W.leads(empty, ["movement_id"], "v", (0, 2)).collect() == []
