"""Language ID by interpolated Kneser-Ney character models.

Texts are lower-cased and cut into words (runs of letters).  A language's model
gives the probability of each character of a word, and of the word's end, from the
``ORDER - 1`` characters before it, filled up with word starts.  Interpolated
Kneser-Ney: absolute discounts from the counts of counts, lower orders from the
number of distinct characters to the left, down to the uniform distribution.

Per language and order the n-grams are 64-bit hashes in a sorted array with their
discounted probabilities beside it, and so are the contexts with their back-off
weights: a look-up is a binary search.  A word's log probability does not depend on
its neighbours, so each task scores a word once and keeps it in a bounded cache.

The language of the lowest cross-entropy per character wins, ties go to the first
name.  ``rejected`` marks texts whose cross-entropy is above the ``KEEP`` quantile of
texts of known language that were kept out of the counts; it does not
change ``lang_pred``.  ``score`` is the share of the winner when the languages' mean
probabilities per character are raised to the power ``SHARPNESS``.

The models are fitted on a bounded sample: about ``TRAIN_ROWS`` rows of each
language, those of the smallest hash of the id; whole texts.  Prediction
reads whole texts of all rows and neither lang nor source nor, but for the
fold, doc_id.

Null texts and texts without a letter are ``und`` with score 0, and so is every
text if there is nothing to learn from.  Repeated rows are repeated in the result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import bounded_batches, id_remainder, per_batch

ORDER = 5
TRAIN_ROWS = 1500  # of a language, about: the bound of the training sample
CALIBRATION = 8  # one in so many of them is kept for the rejection threshold
KEEP = 0.995
SHARPNESS = 8.0
BROADCAST_LANGUAGES = 10_000
UNKNOWN = "und"
CACHE_WORDS = 200_000
CACHE_GRAMS = 500_000
PIECE_CHARS = 1 << 21  # characters looked at together

RUN = re.compile(r"[^\W\d_]+")
START, END = 2, 3  # code points no word holds
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    found = RUN.findall(text.lower())
    return found if any(map(str.isalpha, found)) or not found else [w for w in found if any(map(str.isalpha, w))]


def gram_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n, ORDER) code points of every character and end of ``words`` after its
    context, and the number of the word of each row."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    pad = chr(START) * (ORDER - 1)
    line = "".join([pad + w + chr(END) for w in words])
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    view = np.lib.stride_tricks.sliding_window_view(points, ORDER)
    owner = np.repeat(np.arange(len(words)), sizes + 1)
    begin = np.cumsum(sizes + ORDER) - (sizes + ORDER)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes + 1) - (sizes + 1), sizes + 1)
    return view[begin[owner] + inside], owner


def hashes(grams: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each row of code points."""
    h = np.full(len(grams), np.uint64(grams.shape[1] + 1))
    for column in grams.T:
        h = (h ^ column.astype(np.uint64)) * FACTOR
        h ^= h >> np.uint64(29)
    return h


def order_hashes(grams: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes of the last characters, of their context) for the orders 1 to ORDER."""
    out = []
    for order in range(1, ORDER + 1):
        own = grams[:, ORDER - order:]
        out.append((hashes(own), hashes(own[:, :-1]) if order > 1 else np.zeros(len(own), np.uint64)))
    return out


class KneserNey:
    """One language's model, from distinct n-grams and their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.alphabet = alphabet
        self.levels = []  # for each order, highest first: gram hashes, probabilities, context hashes, weights
        counts = counts.astype(float)
        for order in range(ORDER, 0, -1):
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once else 0.5
            context = hashes(grams[:, :-1]) if order > 1 else np.zeros(len(grams), np.uint64)
            names, where = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(where, counts), np.bincount(where)
            gram = hashes(grams)
            by = np.argsort(gram)
            share = np.maximum(counts - discount, 0) / total[where]
            self.levels.append((gram[by], share[by], names, discount * kinds / total))
            if order > 1:  # lower orders count the distinct characters to the left
                lower, first, n = np.unique(hashes(grams[:, 1:]), return_index=True, return_counts=True)
                grams, counts = grams[first, 1:], n.astype(float)

    @staticmethod
    def _look_up(keys: np.ndarray, values: np.ndarray, h: np.ndarray, absent: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, values[at], absent)

    def log2(self, grams: np.ndarray, hashed: list | None = None) -> np.ndarray:
        """log2 probability of each row's last character after the others; ``hashed``
        is :func:`order_hashes` of the rows, which all models share."""
        p = np.full(len(grams), 1.0 / self.alphabet)
        for (gram, context), (keys, shares, contexts, weights) in zip(hashed or order_hashes(grams), reversed(self.levels), strict=True):
            p = self._look_up(keys, shares, gram, 0.0) + self._look_up(contexts, weights, context, 1.0) * p
        return np.log2(p)


class Scorer:
    """Cross-entropies of texts under all models; one instance per task."""

    def __init__(self, models: list[KneserNey]):
        self.models = models
        self._empty()
        self._empty_grams()

    def _empty_grams(self):
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of the n-grams met, and their bits under each model
        self.values = np.zeros((0, len(self.models)))

    def _gram_bits(self, grams: np.ndarray) -> np.ndarray:
        """(grams, models) log2 probabilities; an n-gram is looked up in the models once."""
        names, first, where = np.unique(hashes(grams), return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_GRAMS:
            self._empty_grams()
        at = np.searchsorted(self.keys, names)
        new = np.ones(len(names), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != names[inside]
        if new.any():
            fresh = grams[first[new]]
            hashed = order_hashes(fresh)
            bits = np.stack([m.log2(fresh, hashed) for m in self.models], 1)
            keys = np.concatenate((self.keys, names[new]))
            order = np.argsort(keys, kind="stable")
            self.keys, self.values = keys[order], np.concatenate((self.values, bits))[order]
            at = np.searchsorted(self.keys, names)
        return self.values[at][where]

    def _empty(self):
        self.index: dict[str, int] = {}
        self.bits = np.zeros((0, len(self.models)))

    def _learn(self, new: list[str]):
        grams, owner = gram_table(new)
        found = self._gram_bits(grams)
        bits = np.stack([np.bincount(owner, found[:, m], len(new)) for m in range(len(self.models))], 1)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.bits = np.concatenate((self.bits, bits))

    def _piece(self, lists: list[list[str]]) -> np.ndarray:
        if len(self.index) > CACHE_WORDS:
            self._empty()
        flat = [w for words in lists for w in words]
        new = [w for w in dict.fromkeys(flat) if w not in self.index]
        if new:
            self._learn(new)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        chars = np.bincount(owner, np.fromiter(map(len, flat), np.int64, len(flat)) + 1, len(lists))
        total = np.stack([np.bincount(owner, self.bits[at, m], len(lists)) for m in range(len(self.models))], 1)
        return -total / np.maximum(chars, 1)[:, None]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per model, has a letter) of each text."""
        out, there, lists, size = [], [], [], 0
        for text in texts:
            words = words_of(text)
            lists.append(words)
            there.append(bool(words))
            size += len(text)
            if size > PIECE_CHARS:
                out.append(self._piece(lists))
                lists, size = [], 0
        if lists:
            out.append(self._piece(lists))
        return (np.concatenate(out) if out else np.zeros((0, len(self.models)))), np.array(there, bool)


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram (string of ORDER characters), n of the rows' (lang, text) words."""

    def run(batches):
        tally: Counter = Counter()

        def flush():
            langs, grams, n = zip(*((lang, g, c) for (lang, g), c in tally.items()), strict=True)
            tally.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, times in Counter(words_of(text)).items():
                    padded = chr(START) * (ORDER - 1) + word + chr(END)
                    for i in range(len(word) + 1):
                        tally[lang, padded[i:i + ORDER]] += times
                if len(tally) > 500_000:
                    yield flush()
        if tally:
            yield flush()

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def training_sample(rows: DataFrame, per_language: int = TRAIN_ROWS) -> DataFrame:
    """About ``per_language`` rows of each language, by a hash of the id; column
    ``calibrate`` marks those kept from the counts."""
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("size"))
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    # a row for each language: broadcast while these are few, so that no text moves but the sample's
    if sizes.count() <= BROADCAST_LANGUAGES:
        sizes = F.broadcast(sizes)
    taken = known.join(sizes, "lang").where(lot * F.col("size") < F.lit(per_language << 20))
    return taken.withColumn("calibrate", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION)) == 0).drop("size")


def learn(rows: DataFrame, per_language: int = TRAIN_ROWS) -> tuple[list[str], list[KneserNey], float]:
    """(language names, their models, cross-entropy above which a text is rejected)
    from the rows' doc_id, text and lang."""
    bounded_batches(rows.sparkSession)
    sample = training_sample(rows, per_language)
    table = gram_counts(sample.where(~F.col("calibrate"))).toArrow().to_pandas()
    langs = sorted(table["lang"].unique())
    if not langs:
        return [], [], float("inf")
    points = np.frombuffer("".join(table["gram"]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
    alphabet = len(np.unique(points)) + 1
    models = []
    for lang in langs:
        own = np.flatnonzero((table["lang"] == lang).to_numpy())
        models.append(KneserNey(points[own], table["n"].to_numpy()[own], alphabet))
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def own_entropy(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            h, there = scorer(batch.column("text").to_pylist())
            number = [langs.index(x) if x in langs else -1 for x in batch.column("lang").to_pylist()]
            keep = [i for i, k in enumerate(number) if k >= 0 and there[i]]
            yield pa.RecordBatch.from_arrays([pa.array([float(h[i, number[i]]) for i in keep], pa.float64())], names=["h"])

    seen = sample.where("calibrate").select("text", "lang").mapInArrow(own_entropy, "h double").toArrow()["h"].to_numpy()
    return langs, models, float(np.quantile(seen, KEEP)) if len(seen) else float("inf")


def predict(docs: DataFrame, langs: list[str], models: list[KneserNey], limit: float) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy (bits a character), rejected per row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by the training sample
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])

    def make():
        scorer = Scorer(shared.value)

        def one(batch):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if not langs:
                n = len(texts)
                return {"doc_id": batch.column("doc_id"), "lang_pred": [UNKNOWN] * n, "score": [0.0] * n,
                        "cross_entropy": [None] * n, "rejected": [True] * n}
            h, there = scorer(texts)
            best = h.argmin(1)
            low = h[np.arange(len(h)), best]
            score = 1 / np.exp2(-(h - low[:, None]) * SHARPNESS).sum(1)
            return {
                "doc_id": batch.column("doc_id"),
                "lang_pred": [langs[b] if t else UNKNOWN for b, t in zip(best.tolist(), there.tolist(), strict=True)],
                "score": np.where(there, score, 0.0),
                "cross_entropy": pa.array(low, mask=~there),
                "rejected": ~there | (low > limit),
            }

        return one

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(per_batch(make, schema), "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def identify(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """``predict`` for all rows with models of the rows whose id remainder is not
    ``held``; adds held_out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    models = learn(rows.where(id_remainder(F.col("doc_id"), folds) != held))
    return predict(rows, *models).withColumn("held_out", id_remainder(F.col("doc_id"), folds) == held)
