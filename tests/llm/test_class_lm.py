import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, documents, remainder, table_texts

from spendlane.llm import class_lm as M
from spendlane.llm.queries import op9_class_lm


def toks(t):
    return [w.decode() for w in M.tokens(t or "")] + [""]


def base(rows):
    """{doc_id: (held, n_tokens, n_known, N, base)}."""
    count = Counter(w for i, t in rows if remainder(i, 5) != 1 for w in toks(t))
    n, v = sum(count.values()), len(count)
    out = {}
    for i, t in rows:
        words = toks(t)
        s = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out[i] = (remainder(i, 5) == 1, len(words), sum(count[w] > 0 for w in words), n, s)
    return out


def compare(rows, want):
    assert len(rows) == len(want)
    for r in rows:
        held, n, known, total, s = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(s, rel=1e-9)


def test_query_over_a_whole_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table_texts(sf_dir)]
    rows = op9_class_lm(spark, sf_dir).collect()
    compare(rows, base(docs))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_are_joined(spark, monkeypatch):
    """With a table of few words nearly all counts come over the join."""
    monkeypatch.setattr(M, "TABLE_WORDS", 3)
    texts = ["the cat sat", "the dog sat on the mat", None, "", "THE\x1ccat É", "new words only", "the cat sat", "x " * 3000] * 3
    ids = list(range(len(texts)))
    rows = M.score_documents(clashing(documents(spark, texts, ids))).collect()
    compare(rows, base(list(zip(ids, texts, strict=True))))
    by = {r.doc_id: r.score for r in M.score_documents(documents(spark, texts, ids)).collect()}
    monkeypatch.setattr(M, "TABLE_WORDS", 100_000)
    for r in M.score_documents(documents(spark, texts, ids)).collect():
        assert r.score == pytest.approx(by[r.doc_id], rel=1e-9)


def test_model_sums_to_one(spark):
    texts = spark.createDataFrame([("a b a c a b 12 zz!",), ("b a b d",), ("c c 7 e",)], "text string")
    _, model, n_all, v_all, table = M.learn(texts, vocabulary=3, classes=2)
    emitted = np.zeros(len(model.divisor))
    known = {w: c for w, c in table.items()}
    num = model.numbering
    for w, c in known.items():
        number = num.end if w == b"" else int(num([w])[0])
        cls = model.of[number]
        emitted[cls] += 10 ** (math.log10(c + M.ALPHA) - model.divisor[cls])
    shapes = model.of[num.first_shape:num.end]
    emitted[shapes] += 10 ** (math.log10(M.ALPHA) - model.divisor[shapes])
    live = 10**model.transitions
    assert np.allclose(live[model.end_class].sum(), 1)
    assert np.allclose(emitted, 1)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    n, fixed = 30, np.array([4])
    hidden = rng.integers(0, 4, n + 1)
    pairs = rng.poisson(np.where((hidden[:, None] + 1) % 4 == hidden[None, :], 20.0, 0.5))

    def likelihood(of):
        member = np.eye(5)[of]
        t = member.T @ pairs @ member
        f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1)), 0).sum()
        return f(t) - f(t.sum(1)) - f(t.sum(0))

    start = np.concatenate((np.arange(n) % 4, fixed))
    found = M.exchange(pairs, n, fixed, 4)
    assert found[-1] == 4 and likelihood(found) > likelihood(start)
    # no single move of a word is better
    for w in range(n):
        for k in range(4):
            other = found.copy()
            other[w] = k
            assert likelihood(other) <= likelihood(found) + 1e-6


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = documents(spark, ["a b", "c rare", "a b", "q"], [1, 1, None, None])
    rows = M.score_documents(docs).collect()
    assert sorted(r.n_tokens for r in rows) == [2, 3, 3, 3]
    assert M.score_documents(documents(spark, [])).collect() == []


def test_no_training_texts(spark):
    held = next(i for i in range(100) if remainder(i, 5) == 1)
    row = M.score_documents(documents(spark, ["a b"], [held])).first()
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0) and row.score <= 0


def test_words_outside_the_vocabulary_are_clustered(spark):
    """Rare words of two kinds, alike in shape, that stand between different frequent ones."""
    rng = np.random.default_rng(5)
    kinds = [[f"{k}{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(5)] for k in "xy"]
    texts = []
    for _ in range(600):
        k = int(rng.integers(0, 2))
        texts.append((" ".join([("the", "to")[k], kinds[k][rng.integers(0, 40)], ("of", "by")[k]] * 2),))
    words, model, _, _, _ = M.learn(spark.createDataFrame(texts, "text string"), vocabulary=4, classes=4)
    of = {r["word"]: r["class"] for r in words.collect()}
    first, second = ({of[w] for w in kind if w in of} for kind in kinds)
    assert len(first) == len(second) == 1 and first != second
    # the class-pair table holds every pair, and each word is in a class that moves
    assert all(c < 4 for w, c in of.items() if w)


def test_classes_do_not_depend_on_buckets(spark, monkeypatch):
    texts = spark.createDataFrame([(f"a{i % 7} b{i % 11} the c{i % 5} of d{i % 13}",) for i in range(300)], "text string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n, words in (("1", 1 << 16), ("5", 1 << 16), ("5", 4), ("3", 1)):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        monkeypatch.setattr(M, "BUCKET_WORDS", words)
        found.append(sorted(map(tuple, M.learn(texts, vocabulary=3, classes=3)[0].collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(f == found[0] for f in found[1:])


ODD_TEXTS = ["the cat  sat", "", " The\tend\n", "x" * 70 + " " + "x" * 70 + " " + "x" * 69 + "y", "É é ÀB\x1cc\x0bd", "\u3000 z\x00 z", "abcdefgh abcdefghi abcdefgh\x00", "end"]


@pytest.mark.parametrize("clash", [False, True])
def test_words_are_cut_and_numbered_together(monkeypatch, clash):
    """All words of a batch at once, without a Python object for each, also where hashes clash."""
    if clash:
        plain = M.Words._hashes
        monkeypatch.setattr(M.Words, "_hashes", lambda self, head, seed: plain(self, head, seed) & np.uint64((0, 1 << 63, 2**64 - 1)[min(seed, 2)]))
    table = [b"the", b"q", b"abcdefghi"]
    words = M.Words([M._cut(pa.array(ODD_TEXTS[:3])), M._cut(pa.array(ODD_TEXTS[3:]))], M.Numbering(table).cut)
    number, place, found = words.looked_up()
    strings = words.strings(place)
    assert len(set(strings)) == len(strings)
    assert [strings[i] for i in number] == [w for t in ODD_TEXTS for w in M.tokens(t)]
    assert words.per_text().tolist() == [len(M.tokens(t)) for t in ODD_TEXTS]
    assert [table.index(w) if w in table else -1 for w in strings] == found.tolist()


def test_counts_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    texts = spark.createDataFrame([(t,) for t in ODD_TEXTS * 3], "text string").coalesce(1)
    want = Counter(w for t in ODD_TEXTS * 3 for w in toks(t))
    for held in (M.PAIRS, 5):
        monkeypatch.setattr(M, "PAIRS", held)
        assert {r["word"]: r["n"] for r in M.word_counts(texts).collect()} == want


def test_sums_of_runs():
    rng = np.random.default_rng(4)
    rows, sizes = rng.integers(0, 99, (20, 3)).astype(float), rng.integers(1, 9, 50)
    at = rng.integers(0, 20, sizes.sum())
    want = np.add.reduceat(rows[at], np.cumsum(sizes) - sizes, axis=0)
    assert (M._row_sums(rows, at, sizes) == want).all()


@pytest.mark.parametrize("kind", [np.uint8, np.uint32, np.int64])
def test_packed_numbers_come_back(kind):
    rng = np.random.default_rng(6)
    for n in (0, 1, 1000):
        x = rng.integers(0, np.iinfo(kind).max, n, kind)
        back = M._unpack(M._pack(x), kind)
        assert back.dtype == kind and (back == x).all()
