import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_compare import compare
from spendlane.llm import topk_search as T
from spendlane.llm.queries import ORACLES, op10_topk_search


def brute(rows, k, every):
    """Sorted result rows; every row is a candidate and maybe a query of its own."""
    vecs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(vecs):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for m, (i, w) in enumerate(vecs) if m != n)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5, every=10):
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, score int, row int")
    got = T.top_k(df, lambda i: F.pmod(i, F.lit(every)) == 0, k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(T, "GROUP", 64)
    monkeypatch.setattr(T, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(seed)
    rows = [(int(i) * (1 if i % 2 else 1000), rng.normal(size=6).round(1 if seed else 3).tolist()) for i in range(400)]
    assert run(spark, rows) == brute(rows, 5, 10)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (10, None), (20, [float("nan"), 1.0]), (30, [1.0, None]), (40, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (50, []), (60, [1.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (70, [0.0, 0.0]), (80, [1e14, -1e14])]
    assert run(spark, rows) == brute(rows, 5, 10)
    assert run(spark, [*rows, rows[0], rows[8]]) == brute([*rows, rows[0], rows[8]], 5, 10)
    # rows that share an id, or repeat each other, are queries and candidates one by one
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])]
    assert run(spark, rows) == brute(rows, 5, 10) and len(brute(rows, 5, 10)) == 8


def test_shared_ids_over_several_groups(spark, monkeypatch):
    """A third of all rows have one id; they are dealt over the groups."""
    monkeypatch.setattr(T, "GROUP", 64)
    rng = np.random.default_rng(9)
    rows = [(10 if i % 3 == 0 else int(i), rng.normal(size=4).round(1).tolist()) for i in range(300)]
    rows += rows[:40]
    assert run(spark, rows) == brute(rows, 5, 10)


def test_few_rows_and_empty_table(spark):
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 131072)]
    assert run(spark, []) == []


def test_blocks_are_pruned(monkeypatch):
    """A block whose bound is below the kth score is never scored."""
    ids = np.arange(10 * T.BLOCK)
    rows = np.ones((len(ids), 2), np.int64)
    rows[:T.BLOCK] = 100
    seen = []
    plain = T.products
    monkeypatch.setattr(T, "products", lambda q, r: seen.append(len(r)) or plain(q, r))
    _, found, _ = T.search_group(np.array([-1]), np.array([[3, 4]]), ids, ids, rows, 5)
    assert sorted(found) == [0, 1, 2, 3, 4] and seen.count(T.BLOCK) == 1


def test_query_equals_sql(spark, sf_dir):
    r = compare(op10_topk_search(spark, sf_dir), ORACLES["op10_topk_search"], sf_dir)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"], r
