import numpy as np
from helpers import clashing, documents, remainder, table_texts

from spendlane.llm import line_quality as Q
from spendlane.llm.queries import op6_line_quality


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_quality(spark, sf_dir):
    label = {r["doc_id"]: r["quality"] for r in table_texts(sf_dir, "labels")}
    rows = op6_line_quality(spark, sf_dir).collect()
    assert len(rows) == len(table_texts(sf_dir))
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    y = np.array([label[r.doc_id] for r in held])
    if len(set(y)) == 2:
        assert auc(np.array([r.score for r in held]), y) > 0.9


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    per = np.array([4, 1, 3])
    emit, trans = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    marginal, pairs = Q.forward_backward(emit, trans, per)
    at, want_pairs = 0, np.zeros((2, 2))
    for n in per:
        total, own = 0.0, np.zeros((n, 2))
        moves = np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            w = np.exp(sum(emit[at + i, y[i]] for i in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            own[np.arange(n), y] += w
            for a, b in zip(y, y[1:], strict=False):
                moves[a, b] += w
        assert np.allclose(marginal[at:at + n], own / total)
        want_pairs += moves / total
        at += n
    assert np.allclose(pairs, want_pairs)


def test_lines_are_split_at_breaks():
    texts = ["a\n\nbb", "", "\n", "c d"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    starts, ends, per = Q._lines(raw, offsets)
    assert per.tolist() == [3, 1, 2, 1]
    assert [bytes(raw[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == [x for t in texts for x in t.split("\n")]
    x, size, per = Q.line_features(raw, offsets, texts)
    assert x.shape == (7, Q.FEATURES) and size.tolist() == [1, 0, 2, 0, 0, 0, 3]


ODD = [None, "", "\n\n", "good clean line\nanother good line", "BAD!!! ###\n$$$", "x" * 200_000, "é日本\x00", "l\n" * 5000, "dup", "dup"]


def test_odd_texts_and_stage(spark):
    texts = ["plain words in a line\nand some more words"] * 40 + ["$$$ ### !!!\n@@@ !!!"] * 40 + ODD
    docs = clashing(documents(spark, texts))
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(80)] + [(3, None, 0), (None, 1, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows.values())
    assert all(rows[i].predicted == int(i < 40) for i in range(80))
    assert rows[88].score == rows[89].score
    kept = Q.accepted(docs, Q.learn(docs, labels))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} & set(range(80)) == set(range(40))


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in Q.classify(documents(spark, ["a", None]), none).collect()] == [0.5, 0.5]
    assert Q.classify(documents(spark, []), none).collect() == []
