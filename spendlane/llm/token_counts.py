"""Token counts by a whole-token shortcut.

Most words of a text are one token of the vocabulary.  ``prove_whole_tokens``
shows once, on the driver, which vocabulary strings the tokenizer encodes alone
as one token: the string must be a single pre-token, untouched by the
normaliser, and the library itself must give one id.  In the tasks, a pre-token
in that set counts 1 without merging; only the others are merged, by the
library's own model, and remembered in a bounded cache.  Texts with characters from
U+0180 on are split by the library; their pre-tokens meet the set in symbol form.

Special strings inside a text count as one token each, as the library does by
default.  Null and empty texts have 0 tokens.  Texts of any length are counted
whole; nothing is truncated.  Repeated rows each get their own row.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import bounded_batches, doc_texts, per_batch
from spendlane.llm.pretokens import OUTSIDE, WORDS, WordCache, byte_alphabet, split_specials

WORD_END = "</w>"


def _load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def prove_whole_tokens(path: str) -> frozenset[str]:
    """The words that the tokenizer at ``path`` encodes alone as one token."""
    tokenizer = _load(path)
    back = {c: b for b, c in byte_alphabet().items()}
    words = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if not entry.endswith(WORD_END):
            continue
        try:
            word = bytes(back[c] for c in entry[: -len(WORD_END)]).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue  # not a text of its own: it only occurs inside longer words
        if not OUTSIDE.search(word) and word == word.lower() and WORDS.fullmatch(word) and WORDS.findall(word) == [word]:
            words.append(word)
    encoded = tokenizer.encode_batch(words, add_special_tokens=False)
    return frozenset(w for w, e in zip(words, encoded, strict=True) if len(e.ids) == 1)


def prove_whole_symbols(path: str) -> frozenset[str]:
    """The symbol strings of vocabulary entries, of any characters, that the
    tokenizer's model gives as one token: pre-tokens as the library splits them."""
    tokenizer = _load(path)
    entries = [e[: -len(WORD_END)] for e in tokenizer.get_vocab(with_added_tokens=False) if e.endswith(WORD_END)]
    return frozenset(e for e in entries if e and len(tokenizer.model.tokenize(e)) == 1)


class TokenCounter:
    """Counts the tokens of one text at a time; one instance per task."""

    def __init__(self, path: str, whole: frozenset[str], symbols: frozenset[str] = frozenset()):
        self.tokenizer = _load(path)
        self.alphabet = [c for _, c in sorted(byte_alphabet().items())]
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))) or r"(?!)")
        self.whole = whole
        self.whole_symbols = symbols
        self.counts = WordCache(self._word)
        self.symbol_counts = WordCache(self._by_symbols)  # of texts that the library splits

    def _symbols(self, word: str) -> str:
        return "".join([self.alphabet[b] for b in word.encode()])

    def _word(self, word: str) -> int:
        if word in self.whole:
            return 1
        return self._merged(self._symbols(word))

    def _by_symbols(self, symbols: str) -> int:
        return 1 if symbols in self.whole_symbols else self._merged(symbols)

    def _merged(self, symbols: str) -> int:
        return len(self.tokenizer.model.tokenize(symbols))

    def _plain(self, text: str) -> int:
        if OUTSIDE.search(text) is None:
            return sum(map(self.counts.__getitem__, WORDS.findall(text.lower())))
        t = self.tokenizer
        parts = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        return sum(self.symbol_counts[symbols] for symbols, _ in parts)

    def __call__(self, text: str) -> int:
        if self.specials.search(text) is None:
            return self._plain(text)
        return sum(1 if special else self._plain(part) for part, special in split_specials(text, self.specials))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (``n_tokens > limit``) per row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    # bounded by the vocabulary of the tokenizer, not by the data
    whole = spark.sparkContext.broadcast((prove_whole_tokens(tokenizer_path), prove_whole_symbols(tokenizer_path)))

    def make():
        count = TokenCounter(tokenizer_path, *whole.value)
        return lambda batch: {
            "doc_id": batch.column("doc_id"),
            "n_bytes": batch.column("n_bytes"),
            "n_tokens": [count(t) for t in batch.column("text").to_pylist()],
        }

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    rows = doc_texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return rows.mapInArrow(per_batch(make, schema), "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > F.lit(limit)
    )
