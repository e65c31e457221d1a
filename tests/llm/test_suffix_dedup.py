import hashlib

import numpy as np
import pytest
from helpers import brute_dedup, clashing, documents, passages, table_texts

from spendlane.llm import suffix_dedup as S
from spendlane.llm.queries import op5_suffix_dedup


def run(spark, texts, ids=None, size=50):
    rows = S.deduplicate(clashing(documents(spark, texts, ids)), size).collect()
    return rows, {r.doc_id: (bytes(r[S.KEPT]), len(r[S.SPANS])) for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    texts = passages(seed, 50)
    texts[3:5] = [None, ""]
    texts += [texts[7]] * 3
    _, got = run(spark, texts)
    assert got == brute_dedup(list(enumerate(texts)), 50)


@pytest.mark.parametrize("hot", [0, 3])
def test_split_anchors_change_nothing(hot):
    """Anchors with many windows are dealt string by string; the steps are run here
    one after the other, as Spark deals their rows."""
    import pyarrow as pa

    texts = passages(7, 40) + ["".join(passages(s, 2)) + "the same passage in ever other surroundings, sixty bytes" * 2 for s in range(30)]
    parts = 3
    tables = [pa.table({"doc_id": [i for i in range(len(texts)) if i % parts == p], "text": [t for i, t in enumerate(texts) if i % parts == p],
                        "part": pa.array([p] * len(range(p, len(texts), parts)), pa.int32())}) for p in range(parts)]
    old, S.HOT_WINDOWS = S.HOT_WINDOWS, hot
    try:
        steps = S._Passes(50, 5)

        def by(rows, *keys):
            tbl = pa.concat_tables(rows)
            values = list(zip(*(tbl.column(k).to_pylist() for k in keys), strict=True))
            return {v: tbl.filter(pa.array([x == v for x in values])) for v in set(values)}

        shared = by([steps.shared(t) for t in by([steps.anchors(t) for t in tables], "bucket").values()], "part")
        windows = by([steps.windows(t, shared[(p,)]) for p, t in enumerate(tables)], "kind", "target")
        groups = by([steps.groups(t) for t in windows.values()], "part")
        got = {}
        for p, t in enumerate(tables):
            tbl, raw, offsets, row, a, b = steps.spans(t, groups[(p,)])
            for r, i in enumerate(tbl.column("doc_id").to_pylist()):
                text, at = b"", int(offsets[r])
                runs = list(zip(a[row == r].tolist(), b[row == r].tolist(), strict=True))
                for s, e in runs:
                    text, at = text + bytes(raw[at:s]), e
                got[i] = (text + bytes(raw[at:int(offsets[r + 1])]), len(runs))
    finally:
        S.HOT_WINDOWS = old
    assert got == brute_dedup(list(enumerate(texts)), 50)


def test_long_texts_cross_chunks(spark):
    """Texts longer than what is hashed at a time: repeats lie across the cuts."""
    a, b = "".join(passages(9, 1500, longest=90)), "".join(passages(10, 900, longest=90))
    assert len(a.encode()) > 1.5 * S.CHUNK
    shifted = "zz" + a[1000:70_000] + b[:5000] + a[:3000]
    _, got = run(spark, [a, shifted, b])
    want = brute_dedup([(0, a), (1, shifted), (2, b)], 50)
    assert got == want


def test_spans_are_what_is_missing(spark):
    texts = passages(4, 30)
    for r in run(spark, texts)[0]:
        raw, kept, at = r.text.encode(), b"", 0
        for start, end in r[S.SPANS]:
            assert at <= start < end
            kept, at = kept + raw[at:start], end
        assert kept + raw[at:] == bytes(r[S.KEPT])


def test_repeated_ids_and_null_ids(spark):
    p = "".join(passages(5, 3)) + "q" * 60
    rows, _ = run(spark, [p, p, p, "x" + p], [5, 5, None, 7])
    by = [(r.doc_id, len(r[S.KEPT])) for r in rows]
    # the null id is the smallest; the two rows of 5 take nothing from each other
    assert sorted(by, key=str) == sorted([(5, 0), (5, 0), (None, len(p.encode())), (7, 1)], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_intervals_are_the_common_prefix_groups(seed):
    rng = np.random.default_rng(seed)
    text = bytes(rng.integers(97, 99, 120).tolist())
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(text[a:], text[b:], strict=False)) if x != y), min(len(text) - a, len(text) - b))
    lcp = [0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)]
    found = {(d, frozenset(order[a:b])) for d, a, b in S.intervals(lcp, 3)}
    want = set()
    for d in range(3, max(lcp) + 1):
        for s in {text[i:i + d] for i in range(len(text) - d + 1)}:
            at = frozenset(i for i in range(len(text)) if text[i:i + d] == s)
            longer = min(common(min(at), x) for x in at)
            if len(at) > 1 and longer == d:
                want.add((d, at))
    assert found == want


def test_whole_characters(spark):
    p = "é" * 60
    docs = clashing(documents(spark, [p, "x" + p + "y", "©" + p[:40] + "z"]))
    rows = {r.doc_id: r for r in S.without_repeats(docs).collect()}
    assert rows[0].text == p and rows[1].text == "xy" and rows[1].n_chars == 2
    rows[2].text.encode()  # whole characters only
    assert S.without_repeats(docs).columns == docs.columns


def test_query_over_a_whole_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table_texts(sf_dir)]
    want = brute_dedup(docs, 50)
    rows = op5_suffix_dedup(spark, sf_dir).collect()
    assert len(rows) == len(docs) and any(r.n_removed for r in rows)
    for r in rows:
        kept, runs = want[r.doc_id]
        assert (r.n_bytes - r.n_removed, r.n_spans, r.kept_sha256) == (len(kept), runs, hashlib.sha256(kept).hexdigest())


def test_empty_table(spark):
    assert S.deduplicate(documents(spark, [])).collect() == []
