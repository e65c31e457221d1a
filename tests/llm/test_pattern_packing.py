import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, documents, table_texts
from tokenizers import Tokenizer

from spendlane.llm import pattern_packing as P
from spendlane.llm.queries import op3_pattern_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def wanted(rows, size):
    tokenizer, out = Tokenizer.from_file(PATH), {}
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out[i, k] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    return out


def check_places(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


ODD = [None, "", "a", "x <|endoftext|> y", "日本語 " * 50, "word " * 1023, "word " * 1022 + "word", "word " * 5000, "Ÿé\x85 ok", "dup", "dup"]


@pytest.mark.parametrize("size", [16, 1024])
def test_pieces_and_places(spark, size):
    rows = P.pack(clashing(documents(spark, ODD)), PATH, size).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, zlib.crc32(bytes(r.ids))) for r in rows}
    assert len(got) == len(rows) and got == wanted(enumerate(ODD), size)
    check_places(rows, size)


def test_query_over_a_whole_table(spark, sf_dir):
    rows = op3_pattern_packing(spark, sf_dir).collect()
    want = wanted([(r["doc_id"], r["text"]) for r in table_texts(sf_dir)], 1024)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    n = check_places(rows, 1024)
    tokens = sum(v[1] for v in want.values())
    assert n <= np.ceil(tokens / 1024) * 1.02 + 2


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = 64
    histogram = np.zeros(size + 1, np.int64)
    lengths = rng.integers(1, size + 1, rng.integers(1, 40))
    histogram[lengths] = rng.integers(1, 500, len(lengths))
    packing = P.plan(histogram, size)
    held = np.zeros(size + 1, np.int64)
    for pattern, repeats in packing:
        assert sum(pattern) <= size and repeats > 0
        for length in pattern:
            held[length] += repeats
    assert (held == histogram).all()


def test_exact_patterns_fill_sequences():
    histogram = np.zeros(65, np.int64)
    histogram[[64, 32, 20, 24]] = [10, 8, 200, 100]
    assert sum(n for _, n in P.plan(histogram, 64)) == 10 + 4 + 100


def test_empty_table(spark):
    assert P.pack(documents(spark, []), PATH).collect() == []
