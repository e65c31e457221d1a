import numpy as np
from helpers import clashing, documents, remainder, table_texts

from spendlane.llm import language_id as L
from spendlane.llm.queries import op4_language_id


def test_held_out_accuracy(spark, sf_dir):
    lang = {r["doc_id"]: r["lang"] for r in table_texts(sf_dir)}
    rows = op4_language_id(spark, sf_dir).collect()
    assert len(rows) == len(lang) and all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_probabilities_sum_to_one():
    words = ["abab", "abba", "baa"]
    grams, _ = L.gram_table(words)
    distinct, n = np.unique(grams, axis=0, return_counts=True)
    model = L.KneserNey(distinct, n, alphabet=4)
    for context in distinct[:, :-1]:
        every = np.array([[*context, c] for c in (ord("a"), ord("b"), L.END, ord("z"))], np.uint32)
        assert abs(np.exp2(model.log2(every)).sum() - 1) < 1e-9


def test_gram_table_is_the_plain_one():
    grams, owner = L.gram_table(["ab", "c"])
    pad = chr(L.START) * (L.ORDER - 1)
    plain = [(pad + "ab" + chr(L.END))[i:i + L.ORDER] for i in range(3)] + [(pad + "c" + chr(L.END))[i:i + L.ORDER] for i in range(2)]
    assert ["".join(map(chr, g)) for g in grams] == plain and owner.tolist() == [0, 0, 0, 1, 1]


def test_odd_texts(spark):
    train = ["the cat sat on the mat"] * 30 + ["der hund und die katze"] * 30
    odd = [None, "", "123 !!", "² ½", "日本語", "the " * 20_000, "the cat", "the cat"]
    texts = train + odd
    langs = ["en"] * 30 + ["de"] * 30 + [None] * len(odd)
    df = clashing(documents(spark, texts, langs=langs))
    rows = {r.doc_id: r for r in L.identify(df).collect()}
    assert len(rows) == len(texts)
    for i in range(60, 64):
        assert rows[i].lang_pred == "und" and rows[i].score == 0 and rows[i].rejected
    assert rows[64].lang_pred in ("en", "de") and rows[65].lang_pred == rows[66].lang_pred == "en"


def test_nothing_to_learn_and_empty_table(spark):
    rows = L.identify(documents(spark, ["some text", None], langs=[None, None])).collect()
    assert [r.lang_pred for r in rows] == ["und", "und"]
    assert L.identify(documents(spark, [])).collect() == []
