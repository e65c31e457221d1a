"""Phrase collocation mining with stripes.

A stripe is keyed by a prefix of zero to three words and counts the words that follow
it; what follows outside the pruned set, or the end of a piece, is counted under an
empty word.  So the sum of a stripe is the count of its prefix, its entries are the
counts of the prefix's extensions, and its largest entry is the longer phrase most
likely to subsume the prefix.  Everything else is read from merged stripes:

1. Prefixes grow by a word per pass over the texts.  A prefix is only taken up, and a
   next word only counted by name, if the phrases within are frequent themselves.
   Tasks look that up in a bit filter of bounded size (``FILTER_BITS``); phrases that
   pass it wrongly are counted and dropped later, so it changes no result.
2. Tasks combine their stripes.  Those of equal key meet in a sorted exchange and are
   merged elementwise while they stream by, one stripe held at a time.
   Prefixes of over a ten-thousandth of all words (at most 10,000 of each length) have
   their stripes cut by next word into ``SLICES``, so no hot prefix is one task's.
3. Prefix totals give the counts of both sides of every cut, entries the phrases,
   maxima over extensions to the right (a stripe's largest entry) and to the left (the
   entry's own phrase without its first word) the subsumption.  A longer phrase with
   enough occurrences passes through one that is a word longer, so one word is enough.

Defined results: a null text is empty, a null lang is ``und``; repeated rows and ids
count as often as they occur; empty texts and tables give no phrase.  Only text and
lang are read.  Texts of any length are taken in windows cut between pieces.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlane.llm.common import utf8_buffers, written

LONGEST = 4  # words of a phrase
FILTER_BITS = 27  # at most 2**27 bits, 16 MB
SLICES = 64
HOT_SHARE = 10_000  # a prefix is hot from a 10,000th of all words on ...
HOT_COUNT = 10_000  # ... and so many occurrences
WINDOW = 4 << 20  # bytes of text taken at once
HELD = 1 << 20  # entries a task holds before they are combined; twice as many are passed on
RANK_SPREAD = 64

# the bytes between words and those between pieces, fixed by the definition of a phrase
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

STRIPE = pa.schema([
    ("lang", pa.string()), ("prefix", pa.string()), ("slice", pa.int32()),
    ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
STRIPE_SQL = "lang string, prefix string, slice int, words array<string>, counts array<long>"
# as tasks pass them on: words (which hold no blank) joined by one, counts as 32-bit integers
PARTIAL = pa.schema([
    ("lang", pa.string()), ("prefix", pa.string()), ("slice", pa.int32()), ("words", pa.string()), ("counts", pa.binary()),
])
PARTIAL_SQL = "lang string, prefix string, slice int, words string, counts binary"
MERGED = STRIPE.append(pa.field("total", pa.int64()))


@contextlib.contextmanager
def larger_batches(spark: SparkSession):
    """Arrow batches bounded by bytes while the stripes are made; restored after."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": "20000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def chained(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its first words and that of its last."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + w
    return (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=xxhash.xxh32_intdigest(lang.encode()))


class Frequent:
    """Bit filter of the frequent phrases of one length, and the hashes of hot ones."""

    def __init__(self, size: int, bits: int, slots: np.ndarray, words: np.ndarray, hot: np.ndarray):
        self.size, self.shift = size, np.uint64(64 - bits)
        self.table = np.zeros(1 << (bits - 6), np.uint64)
        self.table[slots] = words
        self.hot = np.sort(hot)

    def has(self, h: np.ndarray) -> np.ndarray:
        bit = h >> self.shift
        return (self.table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)

    def is_hot(self, h: np.ndarray) -> np.ndarray:
        return np.isin(h, self.hot)


def windows(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``WINDOW`` bytes that end between pieces or texts."""
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo < end:
        hi = min(lo + WINDOW, end)
        text_end = int(offsets[np.searchsorted(offsets, hi)])
        while hi < text_end:
            ahead = np.flatnonzero(KIND[raw[hi:min(hi + 65536, text_end)]] == 2)
            if len(ahead):
                hi += int(ahead[0])
                break
            hi = min(hi + 65536, text_end)
        yield lo, hi
        lo = hi


def cut(raw: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of raw[lo:hi], A-Z lowered, and a number of the piece each is in."""
    raw = raw[lo:hi]
    kind = KIND[raw]
    inside = kind == 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    texts = offsets[(offsets >= lo) & (offsets < hi)] - lo
    start[texts] = inside[texts]
    at = np.flatnonzero(start)
    piece = np.cumsum(kind == 2, dtype=np.int32)[at] + np.searchsorted(texts, at, side="right").astype(np.int32)
    kept = LOWER[raw[inside]]
    begins = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, len(kept)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(begins), pa.py_buffer(kept)])
    return words.dictionary_encode(), piece


class Stripes:
    """What a task holds for one language: codes of words and counts of entries."""

    def __init__(self, lang: str, size: int, frequent: Frequent | None):
        self.lang, self.size, self.frequent = lang, size, frequent
        self.codes, self.words, self.hashes = {}, [b""], np.zeros(1, np.uint64)  # code 0: no word by name
        self.parts, self.held = [], 0

    def _codes(self, dictionary: list[bytes]) -> np.ndarray:
        new = [w for w in dictionary if w not in self.codes]
        if new:
            self.codes.update(zip(new, range(len(self.words), len(self.words) + len(new)), strict=True))
            self.words += new
            self.hashes = np.append(self.hashes, np.array([word_hash(self.lang, w) for w in new], np.uint64))
        return np.fromiter((self.codes[w] for w in dictionary), np.int64, len(dictionary))

    def add(self, words: pa.DictionaryArray, piece: np.ndarray) -> None:
        if not len(words):
            return
        code = self._codes(words.dictionary.to_pylist())[words.indices.to_numpy()]
        p, n = self.size, len(code)
        if p == 0:
            counts = np.bincount(code)
            named = np.flatnonzero(counts)
            self._hold(np.zeros(len(named), np.int64), named, counts[named])
            return
        if n < p:
            return
        # phrases of p words at i, then what follows them
        h = self.hashes[code[:n - p + 1]]
        for j in range(1, p):
            h = chained(h, self.hashes[code[j:n - p + 1 + j]])
        known = self.frequent.has(h) & (piece[:n - p + 1] == piece[p - 1:])
        i = np.flatnonzero(known)
        follows = np.append(known[1:], False)[i]  # the phrase one further on is frequent, too
        after = np.minimum(i + p, n - 1)
        follows &= (i + p < n) & (piece[i] == piece[after])
        nxt = np.where(follows, code[after], 0)
        first = code[i] if p < 2 else code[i] << 32 | code[i + 1]
        self._hold(first, nxt if p < 3 else code[i + 2] << 32 | nxt, np.ones(len(i), np.int64))

    def _hold(self, hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> None:
        self.parts.append(combined(hi, lo, n))
        self.held += len(self.parts[-1][0])
        if self.held > HELD:
            self.combine()

    def combine(self) -> None:
        if len(self.parts) > 1:
            self.parts = [combined(*(np.concatenate(c) for c in zip(*self.parts, strict=True)))]
        self.held = len(self.parts[0][0]) if self.parts else 0

    def out(self) -> Iterator[pa.RecordBatch]:
        self.combine()
        if not self.held:
            return
        (hi, lo, n), p = self.parts[0], self.size
        self.parts, self.held = [], 0
        third, nxt = (lo >> 32, lo & 0xFFFFFFFF) if p == 3 else (np.zeros_like(lo), lo)
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (third[1:] != third[:-1])
        head = np.flatnonzero(new)
        columns = [[], [hi[head]], [hi[head] >> 32, hi[head] & 0xFFFFFFFF], [hi[head] >> 32, hi[head] & 0xFFFFFFFF, third[head]]][p]
        if p:
            h = self.hashes[columns[0]]
            for c in columns[1:]:
                h = chained(h, self.hashes[c])
            hot = self.frequent.is_hot(h)
        else:
            hot = np.ones(len(head), bool)
        run = np.cumsum(new) - 1
        piece = np.where(hot[run], (self.hashes[nxt] % np.uint64(SLICES)).astype(np.int32), 0)
        order = np.lexsort((piece, run))
        run, piece, nxt, n = run[order], piece[order], nxt[order], n[order]
        begin = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (piece[1:] != piece[:-1])))
        vocabulary = pa.array(self.words, pa.binary()).cast(pa.string())
        prefix = [vocabulary.take(pa.array(c)) for c in columns]
        prefix = pc.binary_join_element_wise(*prefix, " ") if prefix else pa.array([""] * len(head))
        for a in range(0, len(begin), 20000):
            b = begin[a:a + 20000]
            end = int(begin[a + 20000]) if a + 20000 < len(begin) else len(n)
            at = np.append(b, end) - b[0]
            words = pa.ListArray.from_arrays(pa.array(at, pa.int32()), vocabulary.take(pa.array(nxt[b[0]:end])))
            counts = [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(n[b[0]:end].astype("<i4"))]
            yield pa.RecordBatch.from_arrays([
                pa.array([self.lang] * len(b), pa.string()), prefix.take(pa.array(run[b])), pa.array(piece[b], pa.int32()),
                pc.binary_join(words, " "), pa.Array.from_buffers(pa.binary(), len(b), counts),
            ], schema=PARTIAL)


def combined(hi: np.ndarray, lo: np.ndarray, n: np.ndarray):
    order = np.lexsort((lo, hi))
    hi, lo, n = hi[order], lo[order], n[order]
    if not len(hi):
        return hi, lo, n
    at = np.flatnonzero(np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])))
    return hi[at], lo[at], np.add.reduceat(n, at)


def counter(size: int, frequent):
    """mapInArrow: stripes of prefixes of ``size`` words, one task's occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value if frequent is not None else None
        held: dict[str, Stripes] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(langs.indices.to_numpy() == code)
                stripes = held.setdefault(lang, Stripes(lang, size, known))
                raw, offsets = utf8_buffers(batch.column("text").take(pa.array(mine)))
                for lo, hi in windows(raw, offsets):
                    stripes.add(*cut(raw, offsets, lo, hi))
            if sum(s.held for s in held.values()) > 2 * HELD:
                for stripes in held.values():
                    yield from stripes.out()
                held.clear()  # codes, too: a task's memory does not grow with what it has read
        for stripes in held.values():
            yield from stripes.out()

    return run


def merger(least: int):
    """mapInArrow over stripes sorted by key: one row per key, the total and the
    entries of ``least`` occurrences on."""

    def merge(rows: pa.Table, last: bool):
        """(complete stripes, the unfinished last one as one row)"""
        rows = rows.combine_chunks()
        n = rows.num_rows
        new = np.zeros(n, bool)
        new[0] = True
        for name in ("lang", "prefix", "slice"):
            c = rows.column(name).combine_chunks()
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        run, head = np.cumsum(new) - 1, np.flatnonzero(new)
        lists = rows.column("words").combine_chunks()
        entries = pa.table({
            "run": np.repeat(run, np.diff(lists.offsets.to_numpy())),
            "word": lists.flatten(), "n": rows.column("counts").combine_chunks().flatten(),
        }).group_by(["run", "word"]).aggregate([("n", "sum")])
        of, count = entries.column("run").to_numpy(), entries.column("n_sum").to_numpy()
        order = np.argsort(of, kind="stable")
        of, count, word = of[order], count[order], entries.column("word").combine_chunks().take(pa.array(order))
        keys = rows.select(["lang", "prefix", "slice"]).take(pa.array(head))
        done = len(head) if last else len(head) - 1

        def listed(keep, first, end):
            at = pa.array(np.searchsorted(of[keep], np.arange(first, end + 1)), pa.int32())
            return pa.ListArray.from_arrays(at, word.take(pa.array(np.flatnonzero(keep)))), pa.ListArray.from_arrays(
                at, pa.array(count[keep], pa.int64()))

        total = np.bincount(of, count, minlength=len(head)) if not len(count) or count.sum() < 2**53 else None
        if total is None:
            total = np.zeros(len(head), np.int64)
            np.add.at(total, of, count)
        named = pc.not_equal(word, "").to_numpy(zero_copy_only=False)
        words, counts = listed((count >= least) & named & (of < done), 0, done)
        complete = keys.slice(0, done)
        complete = pa.RecordBatch.from_arrays([
            *[complete.column(c).combine_chunks() for c in range(3)], words, counts, pa.array(total[:done].astype(np.int64)),
        ], schema=MERGED)
        rest = None
        if not last:
            words, counts = listed(of == done, done, done + 1)
            rest = pa.Table.from_arrays([*keys.slice(done).columns, words, counts], schema=STRIPE)
        return complete, rest

    def opened(batch: pa.RecordBatch) -> pa.Table:
        words = pc.split_pattern(batch.column("words"), " ")
        counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<i4").astype(np.int64)
        return pa.Table.from_arrays([
            *[batch.column(c) for c in ("lang", "prefix", "slice")], words, pa.ListArray.from_arrays(words.offsets, pa.array(counts)),
        ], schema=STRIPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if batch.num_rows:
                rows = opened(batch)
                complete, rest = merge(pa.concat_tables([rest, rows]) if rest is not None else rows, False)
                if complete.num_rows:
                    yield complete
        if rest is not None:
            yield merge(rest, True)[0]

    return run


def stripes(texts: DataFrame, size: int, frequent, least: int) -> DataFrame:
    """Merged stripes of prefixes of ``size`` words: lang, prefix, slice, words, counts, total."""
    partial = texts.mapInArrow(counter(size, frequent), PARTIAL_SQL)
    met = partial.repartition("lang", "prefix", "slice").sortWithinPartitions("lang", "prefix", "slice")
    return written(met.mapInArrow(merger(least), STRIPE_SQL + ", total long"), f"stripes-{size}")


def entries(merged: DataFrame) -> DataFrame:
    """lang, prefix, phrase, a of the frequent entries."""
    phrase = F.when(F.col("prefix") == "", F.col("e.words")).otherwise(F.concat_ws(" ", "prefix", "e.words"))
    return merged.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e")).select(
        "lang", "prefix", phrase.alias("phrase"), F.col("e.counts").alias("a")
    )


def frequent_filter(merged: DataFrame, size: int, all_words: int) -> Frequent | None:
    """Filter of the phrases of ``size`` words that are frequent; None if there are none."""
    found = entries(merged)
    n = found.count()
    if not n:
        return None
    bits = min(FILTER_BITS, max(10, (32 * n).bit_length()))
    hot = max(HOT_COUNT, -(-all_words // HOT_SHARE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            h = np.zeros(batch.num_rows, np.uint64)
            pairs = zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)
            words = [[known.setdefault((lang, w), word_hash(lang, w.encode())) for w in phrase.split(" ")] for lang, phrase in pairs]
            if len(known) > 1 << 18:
                known.clear()
            if words:
                by_place = np.array(words, np.uint64).T
                h = by_place[0]
                for w in by_place[1:]:
                    h = chained(h, w)
            bit = h >> np.uint64(64 - bits)
            is_hot = batch.column("a").to_numpy() >= hot
            slots = np.append((bit >> np.uint64(6)).astype(np.int64), np.full(is_hot.sum(), -1))
            values = np.append(np.uint64(1) << (bit & np.uint64(63)), h[is_hot])
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(values.view(np.int64))], names=["slot", "bits"])

    slots = found.select("lang", "phrase", "a").mapInArrow(run, "slot long, bits long")
    hot_hashes = slots.where("slot < 0").select("bits").distinct().toArrow().column(0).to_numpy()
    table = slots.where("slot >= 0").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    return Frequent(size, bits, table.column("slot").to_numpy(), table.column("bits").to_numpy().view(np.uint64),
                    hot_hashes.view(np.uint64))


def mined(docs: DataFrame, least: int = 30) -> list[DataFrame]:
    """Merged stripes by prefix length 0, 1, ... as far as there are frequent phrases."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    with larger_batches(spark):
        made = [stripes(texts, 0, None, least)]
        all_words = made[0].agg(F.sum("total")).first()[0] or 0
        for size in range(1, LONGEST):
            frequent = frequent_filter(made[-1], size, all_words)
            if frequent is None:
                break
            shared = spark.sparkContext.broadcast(frequent)
            made.append(stripes(texts, size, shared, least))
            shared.unpersist()
    return made


def collocations(docs: DataFrame, least: int = 30, covered: int = 80, first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language.  A
    phrase is dropped if ``covered`` percent of its occurrences lie in one longer phrase."""
    made = mined(docs, least)
    n = made[0].groupBy("lang").agg(F.sum("total").alias("n"))
    if len(made) < 2:
        return n.where("false").selectExpr(
            "lang", "0 as rank", "lang as phrase", "n as a", "n as l", "n as r", "n", "n as score")

    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    # the sum of a stripe is the count of its prefix
    totals = written(
        union(made[1:]).groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f")), "phrase-totals")
    phrases = union([entries(m).withColumn("size", F.lit(size + 1)) for size, m in enumerate(made) if size])
    if len(made) > 2:
        right = union([m.select("lang", F.col("prefix").alias("phrase"), F.array_max("counts").alias("f")) for m in made[2:]])
        left = union([entries(m) for m in made[2:]]).select(
            "lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase"), F.col("a").alias("f"))
        longer = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
        big = "cast({} as decimal(20,0)) * {}"
        phrases = phrases.join(longer, ["lang", "phrase"], "left").where(
            f"longest is null or {big.format('longest', 100)} < {big.format('a', covered)}")
    kept = written(phrases.select("lang", "phrase", "a", "size"), "phrases")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("start"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    for part, name in (("start", "l"), ("rest", "r")):
        cuts = cuts.join(totals.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    score = "cast((cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)"
    lowest = cuts.withColumn("score", F.expr(score)).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # a phrase among the first is among the first of its share of the phrases
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SPREAD))
    some = lowest.withColumn("share", share).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("rank") <= first)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= first)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM cut, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2 AND f >= 30),
inside AS (
  SELECT lang, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase, a AS longer
  FROM found, (SELECT unnest([2, 3]) AS m) WHERE k > m
), longest AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL),
kept AS (
  SELECT found.* FROM found LEFT JOIN longest USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
), cuts AS (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
  FROM kept, (SELECT unnest([1, 2, 3]) AS c) WHERE c < k
), scored AS (
  SELECT c.lang, c.phrase, a, c, l.f AS l, r.f AS r, ((2000000 * a::HUGEINT) // (l.f + r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = head JOIN f r ON r.lang = c.lang AND r.phrase = tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INTEGER AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""
