import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from helpers import clashing, documents
from oracle_compare import compare
from spendlane.llm import phrase_mining as P
from spendlane.llm.queries import ORACLES, op13_phrase_mining

BREAK, BLANK = "[.,;:!?\x0a-\x0d]", "[^\x20\x09]+"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def pieces(text):
    return [re.findall(BLANK, p) for p in re.split(BREAK, lowered(text))]


def counts(rows, longest=4):
    f = defaultdict(Counter)
    for text, lang in rows:
        for w in pieces(text):
            for k in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, covered=80, first=2000):
    out = set()
    for lang, f in counts(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            s, _, lf, rf = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), lf, rf))
        for rank, (s, a, p, lf, rf) in enumerate(sorted(scored)[:first], 1):
            out.add((lang, rank, p.decode(), -a, lf, rf, n, -s))
    return out


def run(spark, rows, least, first=2000):
    df = clashing(documents(spark, [t for t, _ in rows], langs=[x for _, x in rows]))
    got = [tuple(r) for r in P.collocations(df, least=least, first=first).collect()]
    assert len(got) == len(set(got))
    return set(got)


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "The", "Éa", "éa", "x\x1c", "new", "york", "city", "a", "b", "c", "\x00z"]
    seps = [" ", "  ", "\t", ", ", ". ", "\n", " "] + [" "] * 12
    said = ["new york city hall", "the of the of the", "a b c a b c"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(said) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randrange(0, 60))]
        rows.append(("".join(p + rng.choice(seps) for p in parts), rng.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("seed,least", ((0, 3), (1, 8), (2, 30)))
def test_equals_brute_force(spark, seed, least):
    rows = texts(seed)
    got = run(spark, rows, least)
    assert got == brute(rows, least) and (least > 8 or got)


def test_hot_prefixes_are_cut(spark, monkeypatch):
    """With every prefix hot, stripes lie in many slices and nothing changes."""
    monkeypatch.setattr(P, "HOT_COUNT", 1)
    rows = texts(3)
    made = P.mined(documents(spark, [t for t, _ in rows], langs=[x for _, x in rows]), 5)
    assert made[1].where("slice > 0").count() > 0
    assert run(spark, rows, 5) == brute(rows, 5)


def test_odd_texts(spark):
    rows = [(None, "en"), ("", "en"), (" \t .,;", None), ("a", "en")] + [("A b", "en")] * 4 + [("go " * 300000 + "a b", "en")]
    assert run(spark, rows, 4) == brute(rows, 4)
    assert run(spark, [], 1) == set() and run(spark, [("", None)], 1) == set()


def test_first_ranks_and_ties(spark):
    rows = [(f"w{i} v{i}", "en") for i in range(300)] * 2  # all of one score: the phrase decides
    got = run(spark, rows, 2, first=25)
    assert got == brute(rows, 2, first=25) and len(got) == 25


def test_totals_are_counts(spark):
    """The sum of a stripe is the number of occurrences of its prefix."""
    rows = texts(5)
    f = counts(rows)
    made = P.mined(documents(spark, [t for t, _ in rows], langs=[x for _, x in rows]), 5)
    for size, m in enumerate(made):
        for r in m.groupBy("lang", "prefix").agg({"total": "sum"}).collect():
            p = tuple(r.prefix.split(" ")) if r.prefix else ()
            assert r[2] == (f[r.lang][p] if size else sum(c for q, c in f[r.lang].items() if len(q) == 1))


def stream(table, size):
    return iter([pa.RecordBatch.from_pandas(table.iloc[i:i + size], preserve_index=False) for i in range(0, len(table), size)])


def test_windows_and_flushes_change_nothing(monkeypatch):
    """Texts taken in small windows, tasks that pass stripes on often, and stripes that
    arrive in many batches merge to the same counts."""
    import pandas as pd

    rows = [(t, "en") for t, _ in texts(7)]
    table = pd.DataFrame({"lang": ["en"] * len(rows), "text": [t for t, _ in rows]})
    want = {p: c for p, c in counts(rows)["en"].items() if len(p) == 1 and c >= 5}

    def merged():
        made = pa.Table.from_batches(P.counter(0, None)(stream(table, 7)), P.PARTIAL).to_pandas()
        made = made.sort_values(["lang", "prefix", "slice"], kind="stable")
        out = [pa.Table.from_batches([b]).to_pylist() for b in P.merger(5)(stream(made, 2))]
        out = [r for b in out for r in b]
        assert sum(r["total"] for r in out) == sum(len(w) for t, _ in rows for w in pieces(t))
        assert len({r["slice"] for r in out}) == len(out)
        return {(w,): n for r in out for w, n in zip(r["words"], r["counts"], strict=True)}

    assert merged() == want
    monkeypatch.setattr(P, "WINDOW", 40)
    monkeypatch.setattr(P, "HELD", 3)
    assert merged() == want


def test_query_equals_sql(spark, sf_dir):
    r = compare(op13_phrase_mining(spark, sf_dir), ORACLES["op13_phrase_mining"], sf_dir)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"], r
