import random

import pytest
from helpers import clashing, documents

from oracle_compare import compare
from spendlane.llm import decontaminate as D
from spendlane.llm.queries import ORACLES, op8_decontamination


def items(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts, strict=True)], "item_id long, text string, doc_id long")


def brute(docs, tests, words=5, threshold=0.8):
    sets = lambda t: D.shingle_set(D.word_list(t or ""), words)
    out = set()
    for j, t in enumerate(tests):
        want = sets(t)
        for i, d in enumerate(docs):
            n = len(want & sets(d))
            if want and n >= threshold * len(want) - 1e-9:
                out.add((i, j, len(want), n))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    tests = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(40)] + [None, "", "a b c d"]
    docs = [None, "", "short"]
    for t in tests[:30]:
        words = t.split()
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = "changed"
        docs.append(" ".join(rng.choices(vocabulary, k=rng.randrange(0, 300))) + ", " + " ".join(words).upper() + "! tail")
    docs.append(" ".join(tests[:40]))
    got = [(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in D.contamination(clashing(documents(spark, docs)), items(spark, tests)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, tests) and got


def test_minima_reach_every_match():
    for size in range(1, 200):
        missed = size - -(-8 * size // 10)
        assert missed < D.minima_needed(size, 0.8) <= size


def test_blocks_of_items_and_stage(spark, monkeypatch):
    test = "the quick brown fox jumps over the lazy dog again and again"
    docs = documents(spark, ["x " + test + " y", "clean text stays here", None, test, test])
    tests = items(spark, [test, test, "unrelated words that nobody has ever put together"])
    one = sorted((r.doc_id, r.item_id) for r in D.contamination(docs, tests).collect())
    assert one == [(d, i) for d in (0, 3, 4) for i in (0, 1)]
    monkeypatch.setattr(D, "BLOCK_BYTES", 40)
    assert sorted((r.doc_id, r.item_id) for r in D.contamination(docs, tests).collect()) == one
    kept = D.clean(docs, tests)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_empty_tables(spark):
    assert D.contamination(documents(spark, []), items(spark, ["a b c d e f"])).collect() == []
    docs = documents(spark, ["a b c d e f"])
    assert D.contamination(docs, items(spark, [])).collect() == []
    assert D.clean(docs, items(spark, [])).count() == 1


def test_query_equals_sql(spark, sf_dir):
    r = compare(op8_decontamination(spark, sf_dir), ORACLES["op8_decontamination"], sf_dir)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"], r
