import math

import numpy as np
import pytest

from helpers import components
from oracle_compare import compare
from spendlane.llm import embedding_dedup as E
from spendlane.llm.queries import ORACLES, op11_embedding_dedup


def brute(rows, threshold=0.95):
    """Sorted (id, n_links, component_id, kept), one per row."""
    fine = [i for i, (_, v) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(rows[i][1]) for i in fine), default=0)
    m = np.array([[*rows[i][1], *[0.0] * (width - len(rows[i][1]))] for i in fine]).reshape(len(fine), width)
    m = m / np.abs(m).max(axis=1, keepdims=True, initial=0)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= threshold
    edges = [(fine[a], fine[b]) for a, b in zip(*np.nonzero(near), strict=True) if a < b]
    root = components(edges, range(len(rows)))
    links = dict(zip(fine, near.sum(axis=1) - 1, strict=True))
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        ids = [x for x in (least.get(root[i]), vec_id) if x is not None]
        least[root[i]] = min(ids) if ids else None
    return sorted(((v, int(links.get(i, 0)), least[root[i]], v == least[root[i]]) for i, (v, _) in enumerate(rows)), key=repr)


def run(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, class int, home string")
    got = E.near_duplicates(df).collect()
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr)


def planted(seed, n, width, family=0):
    """Random vectors, pairs and chains close to the threshold, a hot family and copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, width))
    out = list(base)
    for i in range(n // 2):
        u = base[i] / np.linalg.norm(base[i])
        for _ in range(i % 3 + 1):
            w = rng.normal(size=width)
            w -= (w @ u) * u
            angle = math.acos(rng.uniform(0.93, 0.9999))
            u = math.cos(angle) * u + math.sin(angle) * w / np.linalg.norm(w)
            out.append(u * rng.uniform(0.1, 9))
    out += [base[0] + rng.normal(scale=0.05, size=width) for _ in range(family)] + [base[1]] * (family // 2)
    ids = rng.permutation(len(out)) * 3
    return [(int(i), v.tolist()) for i, v in zip(ids, out, strict=True)]


@pytest.mark.parametrize("width", (2, 16, 64))
def test_equals_brute_force(spark, monkeypatch, width):
    """Many small cells, tiles cut by members and by partners."""
    monkeypatch.setattr(E, "CELL", 24)
    monkeypatch.setattr(E, "TILE", 16)
    rows = planted(width, 300 if width > 2 else 60, width, family=120)
    assert run(spark, rows) == brute(rows)


def test_hot_family_is_counted_not_compared(spark):
    """A third of all rows near one vector lie in one core: no tile holds their pairs."""
    rows = planted(5, 400, 32, family=400)
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "id long, vec array<double>").groupBy("vec").agg({"*": "count"})
    seen = []
    plain = E.tiles
    classes = df.selectExpr("vec", "`count(1)` as weight", "monotonically_increasing_id() as class").cache()
    try:
        E.tiles = lambda a: seen.append(a.where("core").count()) or plain(a)
        E.class_links(classes, 0.95)
    finally:
        E.tiles = plain
        classes.unpersist()
    assert seen[0] >= 400


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [1.0, None]), (4, [float("inf"), 0.0]), (5, []),
            (6, [0.0, -0.0]), (7, [1.0, 2.0]), (7, [2.0, 4.0]), (7, [-1.0, 0.0]), (7, [-1.0, 0.0]), (None, [1.0, 2.01]),
            (None, [0.0, 5.0]), (None, None), (8, [1e300, 2e300]), (9, [1e-300, 2e-300]), (10, [0.0, -1.0]), (-4, [0.0, -1.0, -0.0]),
            (11, [1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[1:7]) == brute(rows[1:7])
    assert run(spark, []) == []
    assert run(spark, [(3, [1.5])], "float") == [(3, 0, 3, True)]


def test_estimates_are_unbiased_and_bounded():
    """Codes estimate cosines without bias, and the interval holds them."""
    rng = np.random.default_rng(1)
    x = E.unit(rng.normal(size=(400, 64)))
    y = E.unit(0.9 * x[:200] + 0.3 * E.unit(rng.normal(size=(200, 64))))
    turn = E.rotation(64)
    code, factor = E.encoded(x @ turn)
    estimate, half = E.Partners(y @ turn, rng).estimates(slice(None), code, factor)
    off = estimate - y @ x.T
    assert abs(off.mean()) < 0.002 and (np.abs(off) <= half).mean() > 0.9999
    # of unrelated pairs next to none is computed again
    unrelated = y @ x.T < 0.5
    assert ((estimate + half >= 0.95) & unrelated).sum() < 0.001 * unrelated.sum()


def test_recall_of_the_cells(monkeypatch):
    """The share of pairs at the threshold that meet in a cell: the worst case of the search."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    x = E.unit(rng.normal(size=(6000, 64)))
    w = rng.normal(size=x.shape)
    w = E.unit(w - (w * x).sum(axis=1, keepdims=True) * x)
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * w
    centre = E.centres(x[:64], 32, 0.95)

    def cells(rows):
        n = len(rows)
        batch = pa.RecordBatch.from_pydict({"class": list(range(n)), "weight": [1] * n, "vec": list(rows)})
        (out,) = E.assigner(centre, 64, 0.95)(iter([batch]))
        return [(h, set(v)) for h, v in zip(out.column("home").to_pylist(), out.column("visits").to_pylist(), strict=True)]

    met = [a[0] == b[0] or a[0] in b[1] or b[0] in a[1] for a, b in zip(cells(x), cells(y), strict=True)]
    assert np.mean(met) > 0.995


def test_query_equals_sql(spark, sf_dir):
    r = compare(op11_embedding_dedup(spark, sf_dir), ORACLES["op11_embedding_dedup"], sf_dir)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"], r
