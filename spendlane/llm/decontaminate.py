"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is contaminated by a test item if it holds at least ``threshold`` of the
item's distinct word shingles.  Items are short and documents may be long, so a
sketch of the document would see next to nothing of the item; the sketches are
taken of the items.

Items are partitioned by size (number of distinct shingles, powers of two).  In a
partition of items of at most ``u`` shingles a match may miss ``m = u - ceil(threshold
* u)`` of them, so of the ``m + 1`` smallest min-wise hashes of an item a match holds
at least one: these minima are the item's entry in the index.  Every document that
holds one is a candidate, so no match is lost; candidates are verified by exact
containment of the shingles themselves.

Words are runs of letters and digits (any character beyond ASCII counts as a letter)
of the text with A-Z lower-cased.  The index is broadcast in blocks of items whose
text is bounded by ``BLOCK_BYTES``; a larger benchmark takes more blocks.

Null and empty texts match nothing, nor do items with fewer words than a shingle.
Repeated documents and items give one row per pair of rows; a null id stays null.
An empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import bounded_batches, doc_texts
from spendlane.llm.pretokens import WordCache

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BLOCK_BYTES = 16 << 20  # expected text of the items of one broadcast block
FACTOR = 0x9E3779B97F4A7C15
FILTER_BITS = 22


def word_list(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def word_hash(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word, 8)


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hash of each run of ``words`` word hashes."""
    if len(hashes) < words:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(hashes) - words + 1, np.uint64)
    for i in range(words):
        h = h * np.uint64(FACTOR) + hashes[i:len(h) + i]
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xD6E8FEB86659FD93)


def shingle_set(words: list[bytes], n: int) -> set[bytes]:
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def minima_needed(size: int, threshold: float) -> int:
    """How many smallest hashes an item of ``size`` shingles puts into the index: as
    many as its size partition needs."""
    upper = 1 << max(0, (size - 1).bit_length())
    return min(size, upper - math.ceil(threshold * upper - 1e-9) + 1)


class ItemIndex:
    """Minima of a block of items, and their shingles for verification."""

    def __init__(self, items: list[tuple], words: int, threshold: float):
        self.words, self.threshold = words, threshold
        self.items, minima, owners = [], [], []
        for item_id, text in items:
            found = word_list(text)
            shingles = shingle_set(found, words)
            if not shingles:
                continue
            hashes = np.array([word_hash(w) for w in found], np.uint64)
            smallest = np.unique(shingle_hashes(hashes, words))[:minima_needed(len(shingles), threshold)]
            minima.append(smallest)
            owners.append(np.full(len(smallest), len(self.items)))
            self.items.append((item_id, shingles))
        all_minima = np.concatenate(minima) if minima else np.zeros(0, np.uint64)
        order = np.argsort(all_minima, kind="stable")
        self.minima = all_minima[order]
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.minima >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Items with a minimum among the shingle hashes."""
        hashes = np.unique(hashes[self.filter[hashes >> np.uint64(64 - FILTER_BITS)]])
        lo = np.searchsorted(self.minima, hashes, "left")
        hi = np.searchsorted(self.minima, hashes, "right")
        found = [self.owners[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if b > a]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def matches(self, found: list[bytes], candidates: np.ndarray) -> list[tuple]:
        """(item id, its shingles, how many the document holds) at the threshold or above."""
        have = shingle_set(found, self.words) if len(candidates) else set()
        out = []
        for c in candidates.tolist():
            item_id, shingles = self.items[c]
            n = sum(s in have for s in shingles)
            if n >= self.threshold * len(shingles) - 1e-9:
                out.append((item_id, len(shingles), n))
        return out


class DocumentMatcher:
    """Matches of one text at a time; one instance per task."""

    def __init__(self, index: ItemIndex):
        self.index = index
        self.hashes = WordCache(word_hash)

    def __call__(self, text: str) -> list[tuple]:
        found = word_list(text)
        if len(found) < self.index.words or not len(self.index.minima):
            return []
        hashes = np.fromiter(map(self.hashes.__getitem__, found), np.uint64, len(found))
        return self.index.matches(found, self.index.candidates(shingle_hashes(hashes, self.index.words)))


def item_blocks(items: DataFrame, words: int, threshold: float) -> list:
    """Broadcasts of the item index, each of bounded size."""
    bounded_batches(items.sparkSession)
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // BLOCK_BYTES))
    context = items.sparkSession.sparkContext
    blocks = []
    for b in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        blocks.append(context.broadcast(ItemIndex([(r.item_id, r.text) for r in own], words, threshold)))
    return blocks


def contamination(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_shingles, n_found, containment per contaminated pair."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_found", pa.int64())])

    def search(block):
        def run(batches):
            match = DocumentMatcher(block.value)
            for batch in batches:
                rows = [
                    (doc_id, *m)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    for m in match(text)
                ]
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema=schema)

        return doc_texts(docs).mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_found long")

    pairs = None
    for block in item_blocks(items, words, threshold):
        found = search(block)
        pairs = found if pairs is None else pairs.unionByName(found)
    return pairs.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def clean(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns as they are."""
    kept = docs
    for block in item_blocks(items, words, threshold):

        def run(batches, block=block):
            match = DocumentMatcher(block.value)
            for batch in batches:
                yield batch.filter(pa.array([not (t and match(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept


ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+') AS w FROM documents
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+') AS w FROM benchmark
), bs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b)
), n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM f JOIN n USING (item_id) WHERE n_found >= 0.8 * n_shingles - 1e-9
"""
