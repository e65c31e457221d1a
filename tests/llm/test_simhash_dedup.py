import random

import numpy as np
import pytest
from helpers import brute_fingerprint, clashing, components, documents, table_texts

from spendlane.llm import simhash_dedup as H
from spendlane.llm.components import connected_components
from spendlane.llm.queries import op7_simhash_dedup


def wanted(rows, bits=4):
    fps = {i: brute_fingerprint(t) for i, t in rows}
    distinct = np.array(sorted(set(fps.values())), np.uint64)
    edges = []
    for x in distinct:
        for y in distinct[np.bitwise_count(distinct ^ x) <= bits]:
            edges.append((int(x), int(y)))
    comp = components(edges, [int(x) for x in distinct])
    first = {}
    for i, f in sorted(fps.items()):
        first.setdefault(comp[f], i)
    return {i: (f"{f:016x}", first[comp[f]]) for i, f in fps.items()}


def got(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_query_over_a_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table_texts(sf_dir)]
    result = got(op7_simhash_dedup(spark, sf_dir))
    assert result == wanted(rows)
    assert len({c for _, c in result.values()}) < len(rows)


def test_odd_texts(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(200)) for _ in range(4)]
    texts = [None, "", " \t\n", "one", "One", "a b c", "A  b\tc", "a b c d", "É é", "\x1ca b", "w " * 30_000, *base]
    for b in base:
        words = b.split()
        for k in range(6):
            words[rng.randrange(len(words))] = f"new{k}"
            texts.append(" ".join(words))
    result = got(H.near_duplicates(clashing(documents(spark, texts)), 4, 4))
    assert result == wanted(list(enumerate(texts)))


@pytest.mark.parametrize("seed", range(3))
def test_links_of_random_fingerprints(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 20, np.uint64)
    fps = set(map(int, centres))
    for c in centres:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(1, 8), replace=False)
            fps.add(int(c) ^ sum(1 << int(b) for b in flips))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = components([(r.a, r.b) for r in H.near_links(df, 4).collect()], signed)
    arr = np.array(signed, np.int64).view(np.uint64)
    edges = [(signed[i], signed[j]) for i in range(len(arr)) for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 4).tolist()]
    assert found == components(edges, signed)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(200, 230)] + [(7, 7), (300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got_ = {r.node: r.component for r in connected_components(df).collect()}
    want = components([e for e in edges if e[0] != e[1]], {x for e in edges if e[0] != e[1] for x in e})
    assert got_ == want


def test_one_of_each_keeps_all_columns(spark):
    docs = clashing(documents(spark, ["a b c d e f", "a b c d e f", "other words are here now", None, ""], [3, 1, 2, 8, 9]))
    kept = H.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 8]


def test_one_of_each_keeps_exactly_one_row(spark):
    """Repeated rows, equal ids with other texts or columns, and null ids beside others."""
    same, other, third = "a b c d e f", "wholly other words are in here", "and a third text that has its own words"
    rows = [(3, same, "en", "s", 1), (None, same, "en", "s", 1), (None, same, "en", "s", 1), (3, same, "en", "s", 1), (3, same, "de", "s", 1),
            (None, other, "en", "s", 2), (None, other, "en", "s", 2), (None, other, "en", "t", 2), (3, third, "en", "s", 3), (4, third, "en", "s", 3)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = H.one_of_each(docs)
    got_ = kept.select("doc_id", "text").collect()
    assert kept.columns == docs.columns
    assert sorted(map(tuple, got_), key=repr) == sorted([(3, same), (None, other), (3, third)], key=repr)


def test_empty_table(spark):
    assert H.one_of_each(documents(spark, [])).collect() == []
    assert H.near_duplicates(documents(spark, [])).collect() == []
