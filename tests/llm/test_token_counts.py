import public_tokenizers
import pytest
from helpers import clashing, documents, table_texts
from tokenizers import Tokenizer

from spendlane.llm.pretokens import OUTSIDE, PIECES, WORDS
from spendlane.llm.queries import op1_token_counts
from spendlane.llm.token_counts import TokenCounter, prove_whole_symbols, prove_whole_tokens, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "Hello world's end, I'LL go", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "日本語 text ẞ ΑΣ İi",
    "été Å", "x" * 5000, "Ÿ ſ ª ² ½ 12 1234", "\x1c\x85\xa0 tab\tnew\nline", "emoji 😀 ok", "''s 'S don't",
]


def plain(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark):
    rows = token_counts(clashing(documents(spark, ODD * 2)), PATH).collect()
    assert len(rows) == 2 * len(ODD)
    for r in rows:
        text = ODD[r.doc_id % len(ODD)]
        assert (r.n_tokens, r.n_bytes) == (plain(text), len((text or "").encode())), repr(text)
        assert r.over_limit == (r.n_tokens > 2048)


def test_whole_tokens_are_proven():
    whole = prove_whole_tokens(PATH)
    assert len(whole) > 20_000 and "the" in whole
    count = TokenCounter(PATH, frozenset())
    assert all(count(w) == 1 for w in sorted(whole)[::997])


@pytest.mark.parametrize("seed", range(3))
def test_splitting_equals_the_library_on_random_characters(seed):
    import random

    rng = random.Random(seed)
    words, pieces = Tokenizer.from_file(PATH), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(2000):
        text = "".join(chr(rng.choice([rng.randrange(0x180), rng.randrange(128), *b" \n'st\t\xa0"])) for _ in range(rng.randrange(1, 14)))
        if not OUTSIDE.search(text):
            shown = words.pre_tokenizer.pre_tokenize_str(words.normalizer.normalize_str(text))
            assert len(WORDS.findall(text.lower())) == len(shown)
            spans = [s for _, s in pieces.pre_tokenizer.pre_tokenize_str(text)]
            assert PIECES.findall(text) == [text[a:b] for a, b in spans]


def test_query_over_a_whole_table(spark, sf_dir):
    tokenizer = Tokenizer.from_file(PATH)
    rows = table_texts(sf_dir)
    want = {r["doc_id"]: len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows}
    assert {r.doc_id: r.n_tokens for r in op1_token_counts(spark, sf_dir).collect()} == want


def test_empty_table(spark):
    assert token_counts(documents(spark, []), PATH).collect() == []


def test_texts_beyond_latin_use_the_proven_words_and_the_cache(monkeypatch):
    symbols = prove_whole_symbols(PATH)
    assert len(symbols) >= len(prove_whole_tokens(PATH))
    count = TokenCounter(PATH, prove_whole_tokens(PATH), symbols)
    merged, plainly = [], count._merged
    monkeypatch.setattr(count, "_merged", lambda symbols: merged.append(symbols) or plainly(symbols))
    text = "the world \u2014 привет the world привет \u201cthe\u201d " * 3
    assert count(text) == plain(text)
    assert len(merged) == len(set(merged)) and not {"the", "world"} & set(merged)
