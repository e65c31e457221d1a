"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a document is good or bad.  A line's features are counts and ratios of
its characters and words; the field sees those of the line and of its two
neighbours.  Learning maximises the likelihood of labelled documents, each line
taking its document's label, with a penalty on the weights.  Forward-backward gives each
line's marginal; their mean, weighted by line length, is the document's quality,
and a logistic curve fitted on the labelled documents turns it into the score.

The model is fitted on a bounded sample: at most about ``TRAIN_ROWS`` labelled rows of
at most ``TRAIN_LINES`` lines each, those of the smallest hash of the id; whole texts.
Scoring reads whole texts of all rows, and of the other columns only doc_id for the
fold.

Null and empty texts are one empty line and get a score like any other.
Without labels every score is 0.5.  Repeated rows are repeated in the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import bounded_batches, id_remainder, utf8_buffers

TRAIN_ROWS = 4000
TRAIN_LINES = 2000
PENALTY = 1e-3
STEPS = 300

# classes of bytes: 0 lower, 1 upper, 2 digit, 3 space, 4 stop or comma, 5 other ASCII sign, 6 control, 7 beyond ASCII
_CLASS = np.full(256, 7, np.int64)
_CLASS[:32] = 6
_CLASS[127] = 6
_CLASS[32:127] = 5
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[9, 13, 32]] = 3
_CLASS[[ord("."), ord(",")]] = 4
KINDS = 8
FEATURES = KINDS + 9
PIECE = 1 << 20  # bytes looked at together


def _lines(raw: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all lines of the documents, and lines per document."""
    breaks = np.flatnonzero(raw == 10)
    breaks = breaks[(breaks >= offsets[0]) & (breaks < offsets[-1])]
    per = np.searchsorted(breaks, offsets[1:], "left") - np.searchsorted(breaks, offsets[:-1], "left") + 1
    last = np.cumsum(per) - 1
    first = last - per + 1
    starts, ends = np.empty(per.sum(), np.int64), np.empty(per.sum(), np.int64)
    inner_start = np.ones(len(starts), bool)
    inner_start[first] = False
    inner_end = np.ones(len(starts), bool)
    inner_end[last] = False
    starts[first], ends[last] = offsets[:-1], offsets[1:]
    starts[inner_start], ends[inner_end] = breaks + 1, breaks
    return starts, ends, per


def line_features(raw: np.ndarray, offsets: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes of each line, lines of each document)."""
    starts, ends, per = _lines(raw, offsets)
    n, size = len(starts), ends - starts
    lo, hi = int(offsets[0]), int(offsets[-1])
    # a line's number for each of its bytes; line breaks count as control characters of the line they end
    owner = np.repeat(np.arange(n), np.diff(np.concatenate((starts, [hi]))))
    kinds = np.bincount(owner * KINDS + _CLASS[raw[lo:hi]], minlength=n * KINDS).reshape(n, KINDS).astype(float)
    stats = np.zeros((n, 5))
    at = 0
    for text in texts:
        lines = text.split("\n")
        seen: dict[str, int] = {}
        for line in lines:
            words = line.split()
            count = len(words)
            row = stats[at]
            row[0] = count
            if count:
                row[1] = len(set(words)) / count
                row[2] = len(line) / count
                row[3] = sum([not w[-1].isalnum() for w in words]) / count
            row[4] = seen.get(line, 0)
            seen[line] = row[4] + 1
            at += 1
    length = np.maximum(size, 1)
    docs = np.repeat(np.arange(len(per)), per)
    repeated = np.minimum(stats[:, 4], 5) / 5
    return np.column_stack((
        kinds / length[:, None],
        np.log1p(size) / 8, np.log1p(stats[:, 0]) / 6, stats[:, 1], np.minimum(stats[:, 2], 40) / 20, stats[:, 3],
        repeated * (size > 0), size == 0, np.log1p(per)[docs] / 6,
        np.bincount(docs, repeated, len(per))[docs] / per[docs],
    )), size, per


def with_neighbours(x: np.ndarray, per: np.ndarray) -> np.ndarray:
    """A line's features, a 1, and those of the lines before and after it (zeros at
    a document's ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    last = np.cumsum(per) - 1
    before[last - per + 1] = 0
    after[last] = 0
    return np.concatenate((x, np.ones((len(x), 1)), before, after), 1)


def forward_backward(emit: np.ndarray, trans: np.ndarray, per: np.ndarray):
    """Marginals (lines, 2) and expected transitions (2, 2).  All documents advance
    together, one line a step."""
    first = np.cumsum(per) - per
    order = np.argsort(-per, kind="stable")  # longest first: those still running are a prefix
    first, per = first[order], per[order]
    running = np.searchsorted(-per, -np.arange(per.max(initial=0)), "left")  # documents with more than t lines
    move = np.exp(trans)
    peak = emit.max(1, keepdims=True)
    e = np.exp(emit - peak)
    alpha, scale = np.empty_like(e), np.empty(len(e))
    for t, m in enumerate(running.tolist()):
        at = first[:m] + t
        a = e[at] if t == 0 else (alpha[at - 1] @ move) * e[at]
        s = a.sum(1)
        alpha[at], scale[at] = a / s[:, None], s
    beta, pairs = np.ones_like(e), np.zeros((2, 2))
    for t in range(len(running) - 1, 0, -1):
        at = first[:running[t]] + t
        b = e[at] * beta[at] / scale[at][:, None]
        beta[at - 1] = b @ move.T
        pairs += move * (alpha[at - 1].T @ b)
    return alpha * beta, pairs


class LineField:
    """Weights of the field, and the curve from quality to score."""

    def __init__(self, x: np.ndarray, size: np.ndarray, per: np.ndarray, label: np.ndarray):
        """Learns from lines ``x`` (without neighbours) of documents with ``label`` 0 or 1."""
        self.mean, self.spread = x.mean(0), np.maximum(x.std(0), 1e-3)
        z = with_neighbours((x - self.mean) / self.spread, per)
        y = np.repeat(label, per)
        weights = np.zeros(z.shape[1])
        trans = np.zeros((2, 2))
        stays = np.array([[(per - 1)[label == 0].sum(), 0], [0, (per - 1)[label == 1].sum()]], float)
        total = float(len(per))
        m1 = np.zeros(len(weights) + 4)
        m2 = np.zeros_like(m1)
        for step in range(1, STEPS + 1):
            emit = np.column_stack((np.zeros(len(z)), z @ weights))
            marginal, pairs = forward_backward(emit, trans, per)
            grad = np.concatenate((z.T @ (y - marginal[:, 1]) / total - PENALTY * weights,
                                   ((stays - pairs) / total - 0.1 * trans).ravel()))
            m1 = 0.9 * m1 + 0.1 * grad
            m2 = 0.99 * m2 + 0.01 * grad * grad
            move = 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
            weights += move[:-4]
            trans += move[-4:].reshape(2, 2)
        self.weights, self.trans = weights, trans
        self.slope, self.shift = 1.0, 0.0
        q = self.quality(x, size, per)
        for _ in range(200):  # Newton steps of a penalised logistic regression on one variable
            p = 1 / (1 + np.exp(-(self.slope * q + self.shift)))
            r, v = label - p, p * (1 - p) + 1e-9
            g = np.array([(r * q).sum() - 1e-2 * self.slope, r.sum()])
            h = np.array([[(v * q * q).sum() + 1e-2, (v * q).sum()], [(v * q).sum(), v.sum() + 1e-6]])
            d = np.linalg.solve(h, g)
            self.slope, self.shift = self.slope + d[0], self.shift + d[1]
            if np.abs(d).max() < 1e-8:
                break

    def line_marginals(self, x: np.ndarray, per: np.ndarray) -> np.ndarray:
        """Probability of each line to be good."""
        z = with_neighbours((x - self.mean) / self.spread, per)
        emit = np.column_stack((np.zeros(len(z)), z @ self.weights))
        return forward_backward(emit, self.trans, per)[0][:, 1]

    def quality(self, x: np.ndarray, size: np.ndarray, per: np.ndarray) -> np.ndarray:
        """Log odds of the length-weighted mean of the line marginals."""
        weight = size + 1.0
        first = np.cumsum(per) - per
        mean = np.add.reduceat(self.line_marginals(x, per) * weight, first) / np.add.reduceat(weight, first)
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def score(self, x: np.ndarray, size: np.ndarray, per: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.quality(x, size, per) + self.shift)))


def pieces(column):
    """(raw bytes, offsets, texts) of a string column, some documents at a time."""
    column = column.fill_null("")
    raw, offsets = utf8_buffers(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        yield raw, offsets[at:end + 1], column.slice(at, end - at).to_pylist()
        at = end


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> LineField | None:
    """The field learnt from the rows of ``docs`` (doc_id, text) with a quality of 0
    or 1 in ``labels``; None if there are none of either."""
    bounded_batches(docs.sparkSession)
    own = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    texts = docs.select("doc_id", "text")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    n = texts.join(own, "doc_id").count()  # reads ids only
    if not n:
        return None
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    # the lot is drawn before the join, so only texts that may be taken move
    drawn = texts.where((lot * F.lit(n) < F.lit(train_rows << 20)) & (F.coalesce(lines, F.lit(1)) <= TRAIN_LINES))
    taken = drawn.join(own, "doc_id")

    def run(batches):
        for batch in batches:
            quality, at = batch.column("quality").to_pylist(), 0
            for raw, offsets, texts in pieces(batch.column("text")):
                x, size, per = line_features(raw, offsets, texts)
                cuts = np.cumsum(per)[:-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(quality[at:at + len(texts)], pa.int32()),
                     pa.array([a.astype(np.float32).tobytes() for a in np.split(x, cuts)], pa.binary()),
                     pa.array([a.tobytes() for a in np.split(size, cuts)], pa.binary())],
                    names=["doc_id", "quality", "x", "size"],
                )
                at += len(texts)

    rows = taken.mapInArrow(run, "doc_id long, quality int, x binary, size binary").orderBy("doc_id", "x").toArrow()
    label = rows["quality"].to_numpy().astype(float)
    if len(set(label.tolist())) < 2:
        return None
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)
    sizes = rows["size"].to_pylist()
    per = np.array([len(s) // 8 for s in sizes])
    return LineField(x, np.frombuffer(b"".join(sizes), np.int64), per, label)


def batch_scores(model: LineField | None, column) -> np.ndarray:
    out = [np.zeros(0)]
    for raw, offsets, texts in pieces(column):
        out.append(np.full(len(texts), 0.5) if model is None else model.score(*line_features(raw, offsets, texts)))
    return np.concatenate(out)


def score(docs: DataFrame, model: LineField | None) -> DataFrame:
    """doc_id, score, predicted (1 if the score is at least 0.5) per row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches):
        for batch in batches:
            s = batch_scores(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """``score`` for all rows with a field learnt from the rows whose id remainder is
    not ``held``; adds held_out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(rows.where(id_remainder(F.col("doc_id"), folds) != held), labels)
    return score(rows, model).withColumn("held_out", id_remainder(F.col("doc_id"), folds) == held)


def accepted(docs: DataFrame, model: LineField | None) -> DataFrame:
    """The rows of ``docs`` that the field predicts to be good, all columns as they are."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(batch_scores(shared.value, batch.column("text")) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
