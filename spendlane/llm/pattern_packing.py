"""Best-fit packing by length patterns and non-negative least squares.

Documents become pieces of at most ``size`` tokens: a longer one is cut into
pieces of ``size``, its first piece takes what is left over.  The histogram of
piece lengths has at most ``size`` bins however large the corpus is, so the
plan is made on the driver from the histogram alone:

1. enumerate the patterns of up to ``DEPTH`` lengths that fill a sequence
   exactly,
2. fit repeat counts to the histogram by non-negative least squares
   (accelerated projected gradient on the sparse pattern matrix),
3. round the counts down to what the histogram can still pay for,
4. pack the residual lengths by best fit, longest first, whole runs of equal
   open sequences at a time.

The plan is a short list of (pattern, repeats).  The r-th piece of a length
takes the r-th slot of that length, so pieces are placed without moving them:
each task ranks its own pieces, starting from the offsets of the per-partition
histograms.  A length that holds a third of all pieces is ranked by all tasks.

Null texts are empty texts; an empty text is one piece that holds the end token.
Repeated rows are packed once each.  Empty tables give an empty result.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlane.llm.common import bounded_batches, doc_texts, written
from spendlane.llm.pretokens import OUTSIDE, PIECES, WordCache, byte_alphabet, split_specials

DEPTH = 3
ROUNDS = 400
BROADCAST_ROWS = 100_000  # rows of three numbers: the most that is broadcast


class PieceEncoder:
    """Ids of one text at a time, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.alphabet = byte_alphabet()  # as a translation of bytes taken as code points
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_ids = {s: np.array([i], "<u4").tobytes() for s, i in added.items()}
        self.specials = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
        self.ids = WordCache(self._piece)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1")
        return b"".join([self.id_bytes[t.id] for t in self.tokenizer.model.tokenize(shown.translate(self.alphabet))])

    def _plain(self, text: str) -> bytes:
        if OUTSIDE.search(text) is None:
            return b"".join(map(self.ids.__getitem__, PIECES.findall(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.specials.search(text) is None:
            return self._plain(text)
        return b"".join(
            self.special_ids[part] if special else self._plain(part)
            for part, special in split_specials(text, self.specials)
        )


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> PieceEncoder:
    """The worker process keeps it, so that its next task knows the pieces met before;
    the cache is bounded."""
    return PieceEncoder(path)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens."""
    first = n % size or size
    return [(0, min(first, n))] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, 4 bytes an id) and the partition
    ``part`` and place ``rank`` of the piece among those of its length there."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            held = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    row = (doc_id, k, start, length, ids[4 * start:4 * (start + length)], part, int(seen[length]))
                    seen[length] += 1
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
                held += len(ids)
                if held > 16 << 20:
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, rows, strict=True)), schema=schema)
                    rows, held = [[] for _ in range(7)], 0
            if rows[0]:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, rows, strict=True)), schema=schema)

    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids", pa.binary()), ("part", pa.int32()), ("rank", pa.int64())]
    )
    return doc_texts(docs).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary, part int, rank long"
    )


def length_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """(patterns, DEPTH) arrays of up to DEPTH of ``lengths`` (sorted, distinct)
    that add up to ``size``; 0 stands for no length."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    rows = [np.array([[size, 0, 0]])] if there[size] else []
    pair = lengths[(lengths * 2 <= size)]
    pair = pair[there[size - pair]]
    rows.append(np.stack((size - pair, pair, 0 * pair), 1))
    for a in lengths[lengths * 3 <= size]:  # a <= b <= c
        b = lengths[(lengths >= a) & (2 * lengths <= size - a)]
        b = b[there[size - a - b]]
        rows.append(np.stack((size - a - b, b, np.full_like(b, a)), 1))
    return np.concatenate(rows) if rows else np.zeros((0, DEPTH), np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - histogram|, where A holds
    how often each length is in each pattern: accelerated projected gradient."""
    n, bins = len(patterns), len(histogram)
    if not n:
        return np.zeros(0)
    flat, real = patterns.ravel(), (patterns > 0).ravel()
    goal = histogram.astype(float)

    def forward(x):
        return np.bincount(flat[real], np.repeat(x, DEPTH)[real], bins)

    def back(r):
        return (np.where(patterns > 0, r[patterns], 0.0)).sum(1)

    # the largest singular value of A, by power iteration, bounds the step
    v = np.ones(n)
    for _ in range(20):
        v = back(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(ROUNDS):
        new = np.maximum(0.0, y - back(forward(y) - goal) / (norm * 1.05))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def round_down(patterns: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole repeat counts that the histogram can pay for, and what is left of it."""
    left = histogram.copy()
    counts = np.zeros(len(patterns), np.int64)
    # floors first, then what the fractions and the residual still allow, largest first
    for step in (np.floor(x).astype(np.int64), None):
        order = np.argsort(-x, kind="stable")
        for p in order.tolist():
            want = int(step[p]) if step is not None else 1 << 62
            if not want:
                continue
            lengths, times = np.unique(patterns[p][patterns[p] > 0], return_counts=True)
            take = min(want, int((left[lengths] // times).min()))
            if take > 0:
                counts[p] += take
                left[lengths] -= take * times
    return counts, left


def best_fit(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over a histogram: equal open sequences are filled
    as one class, so the work follows the number of classes, not of pieces."""
    classes: dict[int, list[list]] = {}  # room left -> [pattern, how many]
    for length in range(size, 0, -1):
        n = int(histogram[length])
        while n:
            room = next((r for r in range(length, size) if classes.get(r)), None)
            if room is None:
                group, many = (), n // max(1, size // length)
                if many:  # sequences of this length alone
                    each = size // length
                    classes.setdefault(size - each * length, []).append([(length,) * each, many])
                    n -= many * each
                if n:
                    classes.setdefault(size - n * length, []).append([(length,) * n, 1])
                    n = 0
                continue
            group, many = classes[room].pop()
            if not classes[room]:
                del classes[room]
            take = min(n, many)
            classes.setdefault(room - length, []).append([(*group, length), take])
            if many > take:
                classes.setdefault(room, []).append([group, many - take])
            n -= take
    return [(group, many) for groups in classes.values() for group, many in groups]


def plan(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that hold every piece of the histogram exactly once."""
    lengths = np.flatnonzero(histogram)
    patterns = length_patterns(lengths, size)
    counts, left = round_down(patterns, fit_counts(patterns, histogram), histogram)
    fixed = [(tuple(int(v) for v in patterns[p] if v), int(counts[p])) for p in np.flatnonzero(counts)]
    return fixed + best_fit(left, size)


def slots(packing: list[tuple[tuple[int, ...], int]], size: int):
    """Per length: first rank, first sequence and offset of each run of slots."""
    runs: dict[int, list] = {}
    taken = np.zeros(size + 1, np.int64)
    sequence = 0
    for pattern, repeats in packing:
        offset = 0
        for length in pattern:
            runs.setdefault(length, []).append((int(taken[length]), sequence, offset))
            taken[length] += repeats
            offset += length
        sequence += repeats
    return {k: np.array(v, np.int64) for k, v in runs.items()}, sequence


def pack(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids (binary), ids_crc32, sequence_id, offset per
    piece."""
    spark = docs.sparkSession
    bounded_batches(spark)
    cuts = written(pieces(docs, tokenizer_path, size, end_id), "pieces")
    counts = cuts.groupBy("part", "length").agg((F.max("rank") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = written(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "ranks")
    # one row for each length: at most `size` rows reach the driver
    bins = before.groupBy("length").agg(F.sum("n").alias("n")).toPandas()
    histogram = np.zeros(size + 1, np.int64)
    histogram[bins["length"].to_numpy(np.int64)] = bins["n"].to_numpy(np.int64)
    place = spark.sparkContext.broadcast(slots(plan(histogram, size), size)[0])  # bounded by the plan's patterns

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        for v in np.unique(lengths).tolist():
            own, table = np.flatnonzero(lengths == v), place.value[v]
            at = np.searchsorted(table[:, 0], ranks[own], "right") - 1
            sequence[own] = table[at, 1] + ranks[own] - table[at, 0]
            offset[own] = table[at, 2]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    starts = before.select("part", "length", "before")
    if starts.count() <= BROADCAST_ROWS:  # beyond it, an ordinary join on the same keys
        starts = F.broadcast(starts)
    # the checksum is taken before the join, so who does not read the ids does not move them
    cuts = cuts.withColumn("ids_crc32", F.crc32("ids"))
    placed = cuts.join(starts, ["part", "length"]).withColumn("slot", slot("length", F.col("rank") + F.col("before")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "slot.sequence_id", "slot.offset")
