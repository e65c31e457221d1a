"""LM scoring with Brown class-based n-grams.

Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end per text.

*Counts.*  One pass over the training texts counts words, a second one word pairs;
both combine map-side.  The pairs travel packed, in codes instead of words.  The words of
a batch of texts are cut and numbered all at once, by their hashes and then their bytes.

*Exchange clustering.*  All training words are assigned to ``CLASSES`` classes by the
exchange algorithm: each word moves to the class that raises the likelihood of the
class bigrams of the training texts most.  The ``VOCABULARY`` most frequent words move
one after the other on the driver, on their pair counts with each other and with the
classes of all other words (a bounded table).  All others start from classes by hash and
move in tasks: they are dealt by hash to buckets of about ``BUCKET_WORDS`` words with the counts
of their pairs, and per sweep each bucket is sent the classes of their neighbours.  A word's gain
is measured against the class-pair table of the sweep's start; after the first sweep
every other word may move, so that neighbours do not move at once.  Sweeps end when
the likelihood rises by less than ``LEAST_RISE`` of itself, or after ``SWEEPS``; a sweep that
lowers it is not kept.  The start and the end of a text have a class of their own.

*Probability.*  P(token | before) = P(class | class before) * P(token | class).
Class transitions are interpolated with the class unigram by the Witten-Bell rule;
emissions add 0.5.  Words that no training text holds have classes of their own, one
for each shape with one cell for all of them, whose unigram is that of the training
words of this shape that occur once (Good-Turing), so the model sums to one.

*Scoring.*  Counts and classes of the ``TABLE_WORDS`` most frequent words are broadcast, a
bounded table.  Rarer words of a document leave a row (document, word, times); these are
joined with the words' counts and classes, and the document's remaining transitions
are summed then, so a vocabulary of any size is scored exactly.

Null texts are empty: one token, the end.  Texts of any length are scored whole.
Repeated rows are scored, and learnt from, as rows of their own.  Without training
texts N = V = 0: the base score divides 0.5 by 0.5, and the model gives the
same.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from itertools import count as counting

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from spendlane.llm.common import bounded_batches, id_remainder, per_batch, shuffle_partitions, utf8_buffers, written

VOCABULARY = 2000
CLASSES = 64
SWEEPS = 6
LEAST_RISE = 1e-4
TABLE_WORDS = 100_000
BUCKET_WORDS = 1 << 16  # words outside the vocabulary that one group moves
PAIRS = 4_000_000  # words a task holds before it sums them
HELD_BYTES = 64_000_000  # of text a task holds, at most one batch more
LONG = 64  # bytes; longer words are hashed one by one
SHAPES = 8  # of words outside the vocabulary
END = ""  # no word is empty
ALPHA = 0.5
RARE = 1 << 62  # codes of words outside the vocabulary
SHIFT = 1024  # more than the model's classes
TIMES = 32  # gains of smaller counts are looked up

_KIND = np.zeros(256, np.uint8)  # of a byte: 1 a letter, 2 a digit
_KIND[ord("a"):ord("z") + 1] = _KIND[128:] = 1
_KIND[ord("0"):ord("9") + 1] = 2


def tokens(text: str) -> list[bytes]:
    """Words of a text; bytes split at ASCII white space only (``Words`` has the same of many texts)."""
    return text.encode().lower().split()


def shapes(words: list[bytes]) -> np.ndarray:
    """Kinds of words outside the vocabulary, by their characters: 0 and 1 without a
    letter (0: with a digit), 2 and 3 ending in a sign, 4 to 7 all others, by size."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    kinds = np.ones(len(words), np.int32)
    some = np.flatnonzero(sizes)
    if len(some):
        is_ = _KIND[np.frombuffer(b"".join(words), np.uint8)]
        size = sizes[some]
        held = np.bitwise_or.reduceat(is_, np.cumsum(size) - size)
        last = is_[np.cumsum(size) - 1]
        by_size = 4 + (size > 5) + (size > 9) + (size > 14)
        kinds[some] = np.where(held & 1, np.where(last, by_size, 2 + (size > 6)), np.where(held & 2, 0, 1))
    return kinds


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_ODD, _EVEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    """One to one, so different numbers stay different."""
    x = (x ^ x >> np.uint64(32)) * _ODD
    x = (x ^ x >> np.uint64(29)) * _EVEN
    return x ^ x >> np.uint64(32)


def _cut(column: pa.Array):
    """(lower-cased bytes of texts, first byte and size of each word, words before the end of each text)."""
    raw, offsets = utf8_buffers(column)
    low = np.frombuffer(raw[offsets[0]:offsets[-1]].tobytes().lower(), np.uint8)
    offsets = offsets - offsets[0]
    gap = np.append(_SPACE[low], True)
    edge = np.zeros(len(gap), bool)
    edge[offsets] = True  # texts lie side by side
    start, end = ~gap, gap | edge
    start[1:] &= gap[:-1] | edge[1:]
    end[1:] &= ~gap[:-1]
    end[0] = False
    starts = np.flatnonzero(start)
    return low, starts, np.flatnonzero(end) - starts, np.searchsorted(starts, offsets[1:])


class Words:
    """The words of texts, all at once: their places in the lower-cased bytes of the
    texts.  The same words as ``tokens`` of each text, without an object for each.  The words
    of a table, cut like a text, come after them, so both are numbered together."""

    def __init__(self, cuts: list[tuple], table: tuple | None = None):
        first = [x[3] for x in cuts]
        data, starts, sizes, _ = zip(*(cuts if table is None else [*cuts, table]), strict=True)
        bytes_before = np.cumsum([0, *map(len, data)]).tolist()
        words_before = np.cumsum([0, *map(len, starts)]).tolist()
        self.data = np.concatenate([*data, np.zeros(8, np.uint8)])
        self.starts = np.concatenate([x + by for x, by in zip(starts, bytes_before, strict=False)])
        self.sizes = np.concatenate(sizes)
        self.first = np.concatenate([[0], *(x + by for x, by in zip(first, words_before, strict=False))])  # of each text, and the end
        self.texts, self.words = len(self.first) - 1, int(self.first[-1])

    def _eight(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next bytes of words as numbers, at most eight of each."""
        view = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        return view[at] & _MASKS[np.minimum(left, 8)]

    def _bytes(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.starts[i] + self.sizes[i]].tobytes()

    def _parts(self):
        """(words longer than that, their next eight bytes), up to LONG bytes."""
        at = np.flatnonzero(self.sizes > 8)
        for done in range(8, LONG, 8):
            if not len(at):
                return
            yield at, self._eight(self.starts[at] + done, self.sizes[at] - done)
            at = at[self.sizes[at] > done + 8]

    def _hashes(self, head: np.ndarray, seed: int) -> np.ndarray:
        h = _mixed(head ^ _mixed(self.sizes.astype(np.uint64) + np.uint64(seed << 40)))
        for at, part in self._parts():
            h[at] = _mixed(h[at] ^ _mixed(part + _ODD))
        for i in np.flatnonzero(self.sizes > LONG).tolist():
            h[i] = xxh64_intdigest(self._bytes(i), seed)
        return h

    def distinct(self):
        """(number of each word, how often each number occurs, a place of each number).
        Words are sorted by hash; equal hashes are compared by their bytes, and
        others tried where two words share one."""
        size = len(self.starts)
        if not size:
            return (np.zeros(0, np.int64),) * 3
        head = self._eight(self.starts, self.sizes)
        for seed in counting():
            h = self._hashes(head, seed)
            if seed == 0 and size < 1 << 24:  # the places in the low bits: sorted sooner than places by hash
                low = np.uint64((1 << size.bit_length()) - 1)
                h = np.sort(h & ~low | np.arange(size, dtype=np.uint64))
                order = (h & low).astype(np.int64)
                h &= ~low
            else:
                order = np.argsort(h)
                h = h[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            by, long = head[order], self.sizes[order]
            if not (new[1:] | (by[1:] == by[:-1]) & (long[1:] == long[:-1])).all():
                continue
            starts = np.flatnonzero(new)
            place = order[starts]
            number = np.empty(size, np.int64)
            number[order] = np.cumsum(new) - 1
            if self._same(place, number):
                return number, np.diff(np.append(starts, size)), place

    def _same(self, place: np.ndarray, number: np.ndarray) -> bool:
        """Whether words of one number, of one size and with equal first bytes, are equal."""
        full = np.zeros(len(self.starts), np.uint64)
        for at, part in self._parts():
            full[at] = part
            if not (part == full[place[number[at]]]).all():
                return False
        return all(self._bytes(i) == self._bytes(place[number[i]]) for i in np.flatnonzero(self.sizes > LONG).tolist())

    def looked_up(self):
        """(number of each word of the texts, a place of each number, its place in the table or -1)."""
        number, _, place = self.distinct()
        found = np.full(len(place), -1)
        found[number[self.words:]] = np.arange(len(number) - self.words)
        return number[:self.words], place, found

    def strings(self, place: np.ndarray) -> list[bytes]:
        raw, _, sizes, _ = self.cut(place)
        raw, ends = raw.tobytes(), np.cumsum(sizes)
        return [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]

    def cut(self, place: np.ndarray) -> tuple:
        """Some of the words as one text, side by side."""
        sizes = self.sizes[place]
        starts = np.cumsum(sizes) - sizes
        return self.data[np.repeat(self.starts[place] - starts, sizes) + np.arange(sizes.sum())], starts, sizes, np.array([len(place)])

    def per_text(self) -> np.ndarray:
        return np.diff(self.first)


def _with_ends(number: np.ndarray, per_text: np.ndarray, end: int) -> np.ndarray:
    """The numbers of all tokens: those of the words, and each text's end."""
    out = np.full(len(number) + len(per_text), end, np.int64)
    out[np.arange(len(number)) + np.repeat(np.arange(len(per_text)), per_text)] = number
    return out


class _Held:
    """Texts a task holds: the distinct words of each batch, and the numbers of all."""

    def __init__(self):
        self.cuts, self.numbers, self.times, self.sizes = [], [], [], []
        self.words = self.texts = self.bytes = 0

    def add(self, column: pa.Array):
        words = Words([_cut(column)])
        number, n, place = words.distinct()
        self.cuts.append(words.cut(place))
        self.numbers.append(number.astype(np.uint32))
        self.times.append(n)
        self.sizes.append(words.per_text())
        self.words, self.texts, self.bytes = self.words + words.words, self.texts + words.texts, self.bytes + len(self.cuts[-1][0])

    def full(self) -> bool:
        return self.words + self.texts > PAIRS or self.bytes > HELD_BYTES

    def tokens(self, number: np.ndarray, words: Words, end: int) -> np.ndarray:
        """The numbers of all tokens, given those of the batches' distinct words; an end goes before."""
        out, at = np.full(1 + self.words + self.texts, end, np.uint32), 1
        for x, sizes, by in zip(self.numbers, self.sizes, words.first.tolist(), strict=False):
            part = _with_ends(number[x + by], sizes, end)
            out[at:at + len(part)] = part
            at += len(part)
        return out


def _held(batches):
    """A task's texts, as many at a time as it may hold."""
    held = _Held()
    for batch in batches:
        if batch.num_rows:
            held.add(batch.column("text"))
        if held.full():
            yield held
            held = _Held()
    if held.texts:
        yield held


def word_counts(texts: DataFrame) -> DataFrame:
    """word (string), n over all rows; END counts the texts."""

    def run(batches):
        for held in _held(batches):
            words = Words(held.cuts)
            number, _, place = words.distinct()
            n = np.bincount(number, np.concatenate(held.times), len(place)).astype(np.int64)
            order = np.argsort(place)  # as they come in the texts: packs better
            n, place = n[order], place[order]
            # strings: lower-cased UTF-8 split at ASCII stays valid
            word = pa.array([b"", *words.strings(place)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([word, pa.array(np.append(held.texts, n), pa.int64())], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Table(dict):
    """Numbers of words; a word that is not there has -1."""

    def __missing__(self, word):
        return -1


class Numbering:
    """word -> number: the vocabulary first, then one number for each shape; the
    end of a text (also what stands before its first word) comes last."""

    def __init__(self, vocabulary: list[bytes]):
        self.table = _Table((w, i) for i, w in enumerate(vocabulary))
        self.cut = _cut(pa.array([b" ".join(vocabulary)], pa.binary()))
        self.first_shape = len(vocabulary)
        self.end = len(vocabulary) + SHAPES
        self.size = self.end + 1

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k != "table"}  # tasks look words up by the cut

    def __call__(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.table.__getitem__, words), np.int64, len(words))
        others = np.flatnonzero(out < 0)
        out[others] = self.first_shape + shapes([words[i] for i in others.tolist()])
        return out


def _f(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(pairs: np.ndarray, movable: int, fixed: np.ndarray, classes: int, sweeps: int = SWEEPS, start: np.ndarray | None = None) -> np.ndarray:
    """Classes of all numbers.  ``pairs`` (numbers, numbers) counts pairs; the first
    ``movable`` numbers move among ``classes`` classes, the others keep ``fixed``.

    The likelihood of the class bigrams is, but for a constant, the sum of f(n) =
    n log n over the cells of the class-pair table minus those over its row and
    column sums.  A word's move changes two rows and two columns only."""
    n, total = len(pairs), int(fixed.max()) + 1
    of = np.concatenate((np.arange(movable) % classes if start is None else start, fixed)).astype(np.int64)
    pairs = pairs.astype(np.float64)
    member = np.zeros((n, total))
    member[np.arange(n), of] = 1
    table = member.T @ pairs @ member

    f = _f
    rows_of, cols_of = pairs.sum(1), pairs.sum(0)
    loops = np.diagonal(pairs).copy()
    for _ in range(sweeps if classes > 1 else 0):
        moved = 0
        for w in range(movable):
            c = of[w]
            out = np.bincount(of, pairs[w], total)  # what follows w, by class
            into = np.bincount(of, pairs[:, w], total)
            loop = loops[w]
            out[c] -= loop
            into[c] -= loop
            # take w out of its class
            table[c] -= out
            table[:, c] -= into
            table[c, c] -= loop
            row_sum, col_sum = table.sum(1), table.sum(0)
            # gain of putting it into each class k: row k, column k and their sums change
            gain = (f(table[:classes] + out) - f(table[:classes])).sum(1)
            gain += (f(table[:, :classes].T + into) - f(table[:, :classes].T)).sum(1)
            k = np.arange(classes)
            cell = table[k, k]
            gain += f(cell + out[k] + into[k] + loop) + f(cell) - f(cell + out[k]) - f(cell + into[k])
            gain -= f(row_sum[k] + rows_of[w]) - f(row_sum[k]) + f(col_sum[k] + cols_of[w]) - f(col_sum[k])
            best = int(gain.argmax())
            if gain[best] <= gain[c] + 1e-9:
                best = int(c)
            table[best] += out
            table[:, best] += into
            table[best, best] += loop
            if best != c:
                of[w], moved = best, moved + 1
        if not moved:
            break
    return of


def rare_code(word: bytes) -> int:
    """Code of a word outside the vocabulary: RARE or more, with 48 bits of hash.
    Words that shared a code would share a class; their counts stay apart."""
    return RARE | (xxh64_intdigest(word, 9) >> 16)


@functools.cache
def _packer():
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _pack(array: np.ndarray) -> bytes:
    """Compressed by byte: first bytes of all numbers, then second ones."""
    array = np.ascontiguousarray(array)
    return _packer()[0].compress(array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes())


def _unpack(blob: bytes, kind) -> np.ndarray:
    by_byte = np.frombuffer(_packer()[1].decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(by_byte.T).view(kind).ravel()


def _pack_sorted(array: np.ndarray, kind=np.int64) -> bytes:
    """A rising array as its differences."""
    return _pack(np.diff(array, prepend=0).astype(kind))


def _unpack_sorted(blob: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(_unpack(blob, kind), dtype=np.int64)


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the code, so sorted codes are sorted by bucket."""
    return ((codes - RARE) >> 17) * buckets >> 31


def _runs(values: np.ndarray):
    """Slices of equal neighbours."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    return [slice(a, b) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True) if b > a]


def dealt_pairs(texts: DataFrame, numbering, buckets: int) -> DataFrame:
    """bucket, codes, a, b, n (packed arrays): counts of word pairs, from one pass; texts
    begin and close with the end.  The pairs with a word outside the vocabulary go to the
    bucket of each such word, a and b being places in codes; bucket -1 - i has the counts of
    all numbers b after number i."""

    def run(batches):
        num = numbering.value
        cells = np.zeros(num.size * num.size, np.int64)

        def rows(held):
            words = Words(held.cuts, num.cut)
            local, place, code = words.looked_up()
            number, others = code.copy(), np.flatnonzero(code < 0)
            for lo in range(0, len(others), 1 << 16):
                some = others[lo:lo + (1 << 16)]
                strings = words.strings(place[some])
                number[some] = num.first_shape + shapes(strings)
                code[some] = np.fromiter(map(rare_code, strings), np.int64, len(strings))
            held.cuts = []
            code, number = np.append(num.first_shape, code), np.append(num.end, number)
            order = np.argsort(code, kind="stable")
            rank = np.empty(len(code), np.int64)
            rank[order] = np.arange(len(code))
            code, number = code[order], number[order]
            flat = held.tokens(rank[1:][local], words, rank[0])  # texts share the end between them
            keys = flat[:-1].astype(np.uint64)
            keys <<= np.uint64(32)
            keys |= flat[1:]
            keys.sort()
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            n = np.diff(np.append(first, len(keys))).astype(np.uint32)
            keys = keys[first]
            del flat, first
            a, b = (keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32)
            del keys
            np.add.at(cells, number[a] * num.size + number[b], n)
            bucket = np.where(code >= RARE, _bucket(code, buckets), -1).astype(np.int32)
            of_a, of_b = bucket[a], bucket[b]
            small = np.uint16 if buckets <= 1 << 16 else np.int64
            there, place = np.zeros(len(code), bool), np.zeros(len(code), np.uint32)
            # a pair within one bucket goes there once
            for of, rare in ((of_a, np.flatnonzero(of_a >= 0)), (of_b, np.flatnonzero((of_b >= 0) & (of_b != of_a)))):
                rare = rare[np.argsort(of[rare].astype(small), kind="stable")]
                for run in _runs(of[rare]):
                    part = rare[run]
                    there[a[part]] = there[b[part]] = True
                    used = np.flatnonzero(there)
                    there[used], place[used] = False, np.arange(len(used))
                    yield int(of[part[0]]), _pack_sorted(code[used]), _pack_sorted(place[a[part]].astype(np.int64), np.uint32), _pack(place[b[part]]), _pack(n[part])

        def batch_of(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)],
                names=["bucket", "codes", "a", "b", "n"])

        for held in _held(batches):
            if found := list(rows(held)):
                yield batch_of(found)
        table = cells.reshape(num.size, num.size)
        full = [(i, np.flatnonzero(x)) for i, x in enumerate(table)]
        if found := [(-1 - i, b"", b"", _pack(at.astype(np.uint32)), _pack(table[i, at])) for i, at in full if len(at)]:
            yield batch_of(found)

    return texts.select("text").mapInArrow(run, "bucket int, codes binary, a binary, b binary, n binary")


def pair_table(static: DataFrame, size: int) -> np.ndarray:
    """Counts of all pairs of numbers, at most the square of the numbers."""
    pairs = np.zeros((size, size))
    for r in static.where("bucket < 0").select("bucket", "other", "n").toArrow().to_pylist():
        pairs[-1 - r["bucket"], _unpack(r["other"], np.uint32)] = _unpack(r["n"], np.int64)
    return pairs


class _Buckets:
    """Words outside the vocabulary, dealt to buckets by hash.  A bucket holds the
    pairs of its words; of the words next to them that lie in other buckets it is sent
    the classes, one byte each, in the order of their codes."""

    static_ddl = "bucket int, source int, codes binary, own binary, other binary, n binary"
    message_ddl = "bucket int, source int, classes binary"
    names = {static_ddl: ("bucket", "source", "codes", "own", "other", "n"), message_ddl: ("bucket", "source", "classes")}

    def __init__(self, end: int, classes: int, buckets: int):
        self.end, self.classes, self.buckets = end, classes, buckets
        self.total = classes + 1

    def rows(self, ddl: str, rows: list[tuple]) -> pa.Table:
        kinds = [pa.int32() if x.split()[1] == "int" else pa.binary() for x in ddl.split(", ")]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=self.names[ddl])

    def build(self, tbl: pa.Table) -> pa.Table:
        """Source -1: the bucket's own words and pairs (place of the word, direction,
        number of the neighbour).  Other sources: words whose classes they need.  A bucket
        below 0 is a row of the table of numbers, summed."""
        q = tbl.column("bucket")[0].as_py()
        if q < 0:
            sums = np.zeros(self.end + SHAPES + 1, np.int64)
            for b, n in zip(tbl.column("b").to_pylist(), tbl.column("n").to_pylist(), strict=True):
                sums[_unpack(b, np.uint32)] += _unpack(n, np.int64)
            at = np.flatnonzero(sums)
            return self.rows(self.static_ddl, [(q, -1, b"", b"", _pack(at.astype(np.uint32)), _pack(sums[at]))])
        codes = [_unpack_sorted(x) for x in tbl.column("codes").to_pylist()]
        a = [_unpack_sorted(x, np.uint32) for x in tbl.column("a").to_pylist()]
        b, n = ([_unpack(x, t) for x in tbl.column(c).to_pylist()] for c, t in (("b", np.uint32), ("n", np.uint32)))
        shift = np.cumsum([0, *map(len, codes)])
        every, place = np.unique(np.concatenate(codes), return_inverse=True)
        a, b = (np.concatenate([place[x.astype(np.int64) + by] for x, by in zip(side, shift[:-1].tolist(), strict=True)]) for side in (a, b))
        key = a << 32 | b
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.add.reduceat(np.concatenate(n)[order].astype(np.int64), first)
        a, b = key[first] >> 32, key[first] & 0xFFFFFFFF
        rare = int(np.searchsorted(every, RARE))
        near = every[rare:]  # its own words too
        of = _bucket(near, self.buckets)
        lo, hi = (rare + int(np.searchsorted(of, q, side)) for side in ("left", "right"))
        slots = np.concatenate((every[:rare], self.end + 1 + np.arange(len(near))))
        mine_a, mine_b = ((x >= lo) & (x < hi) for x in (a, b))
        own = np.concatenate(((a[mine_a] - lo) * 2, (b[mine_b] - lo) * 2 + 1))
        slot = slots[np.concatenate((b[mine_a], a[mine_b]))]
        n = np.concatenate((n[mine_a], n[mine_b]))
        order = np.argsort(own << 32 | slot)
        out = [(q, -1, _pack_sorted(every[lo:hi]), _pack_sorted(own[order], np.uint32), _pack(slot[order].astype(np.uint32)), _pack(n[order]))]
        for run in _runs(of):
            out.append((int(of[run.start]), q, _pack_sorted(near[run]), b"", b"", b""))
        return self.rows(self.static_ddl, out)

    def send(self, static: pa.Table, words: np.ndarray, classes: np.ndarray) -> pa.Table:
        p, out = static.column("bucket")[0].as_py(), []
        for q, blob in zip(static.column("source").to_pylist(), static.column("codes").to_pylist(), strict=True):
            if q >= 0:
                out.append((q, p, _pack(classes[np.searchsorted(words, _unpack_sorted(blob))].astype(np.uint8))))
        return self.rows(self.message_ddl, out)

    def own(self, static: pa.Table) -> dict:
        return next(r for r in static.to_pylist() if r["source"] == -1)

    def first(self, static: pa.Table) -> pa.Table:
        words = _unpack_sorted(self.own(static)["codes"])
        return self.send(static, words, (words >> 4) % self.classes)

    def state(self, static: pa.Table, messages: pa.Table):
        """(own row, words, their classes, classes of the neighbours by slot)."""
        row = self.own(static)
        words = _unpack_sorted(row["codes"])
        sent = {m["source"]: _unpack(m["classes"], np.uint8) for m in messages.to_pylist()}
        near = np.concatenate([sent[p] for p in sorted(sent)]).astype(np.int64)
        # its own words are all among them, one run
        at = sum(len(x) for p, x in sent.items() if p < row["bucket"])
        return row, words, near[at:at + len(words)], near

    def tables(self, static: pa.Table, messages: pa.Table) -> pa.Table:
        """a, b, n: counts of pairs with a word outside the vocabulary, summed; it is
        given as END + 1 + its class, so cells do not grow with the corpus."""
        row, words, mine, near = self.state(static, messages)
        key, slot, n = _unpack_sorted(row["own"], np.uint32), _unpack(row["other"], np.uint32).astype(np.int64), _unpack(row["n"], np.int64)
        size, first = self.end + 1 + self.total, self.end + 1
        back, rare = key & 1 == 1, slot > self.end
        there = slot.copy()
        there[rare] = first + near[slot[rare] - first]
        keep = ~(rare & back)  # a pair of two such words counts where the first is
        sums = np.bincount(((back * self.total + mine[key >> 1]) * size + there)[keep], n[keep], 2 * self.total * size)
        cells = np.flatnonzero(sums)
        here, there, back = first + cells // size % self.total, cells % size, cells >= self.total * size
        return pa.table({"a": np.where(back, there, here), "b": np.where(back, here, there), "n": sums[cells].astype(np.int64)})

    def choose(self, static: pa.Table, messages: pa.Table, table: np.ndarray, vocabulary: np.ndarray, turn: int) -> pa.Table:
        """Moves each word (after the first sweep, every other) to its best class, as
        gained against the class-pair table of the sweep's start."""
        row, words, mine, near = self.state(static, messages)
        key, slot, n = _unpack_sorted(row["own"], np.uint32), _unpack(row["other"], np.uint32).astype(np.int64), _unpack(row["n"], np.int64)
        k, total = self.classes, self.total
        word, back, cls = key >> 1, key & 1, np.concatenate((vocabulary, near))[slot]
        due = (words & 1) == turn % 2 if turn else np.ones(len(words), bool)
        here = due[word]
        word, back, cls, n = (np.cumsum(due) - 1)[word[here]], back[here], cls[here], n[here]
        old, count = mine[due], np.bincount(word, np.where(back == 0, n, 0), due.sum())
        sides = np.stack((table.T[:, :k], table[:, :k]))  # direction, neighbour's class, class of the word
        few = np.stack([_f(sides + x) - _f(sides) for x in range(TIMES)]).reshape(-1, k)
        margins = table.sum(1)[:k], table.sum(0)[:k]
        added = [np.stack([_f(margin + x) - _f(margin) for x in range(TIMES)]) for margin in margins]
        best = old.copy()
        for lo in range(0, len(old), 2048):
            hi = min(lo + 2048, len(old))
            s = slice(*np.searchsorted(word, (lo, hi)))
            sums = np.bincount(((word[s] - lo) * 2 + back[s]) * total + cls[s], n[s], (hi - lo) * 2 * total)
            cells = np.flatnonzero(sums > 0)
            side, x, home = cells % (2 * total), sums[cells].astype(np.int64), old[lo:hi]
            w, cell = cells // (2 * total), sides.reshape(-1, k)
            many = np.flatnonzero(x >= TIMES)
            at = np.minimum(x, TIMES - 1) * (2 * total) + side
            at[many] = len(few) + np.arange(len(many))
            rows = np.concatenate((few, _f(cell[side[many]] + x[many, None]) - _f(cell[side[many]])))
            gain = _row_sums(rows, at, np.bincount(w, minlength=hi - lo))
            cell = cell[side, home[w]]  # its own class is taken without it
            m, each = count[lo:hi].astype(np.int64), np.arange(hi - lo)
            gain[each, home] = np.bincount(w, _f(cell) - _f(cell - x), hi - lo)
            many = np.flatnonzero(m >= TIMES)
            for margin, few_added in zip(margins, added, strict=True):
                more = few_added[np.minimum(m, TIMES - 1)]
                more[many] = _f(margin + m[many, None]) - _f(margin)
                more[each, home] = _f(margin[home]) - _f(margin[home] - m)  # its own class is taken without it
                gain -= more
            to = gain.argmax(1)
            best[lo:hi] = np.where(gain[each, to] > gain[each, home] + 1e-9, to, home)
        new = mine.copy()
        new[due] = best
        return self.send(static, words, new)

    def classes_of(self, static: pa.Table, messages: pa.Table) -> pa.Table:
        _, words, mine, _ = self.state(static, messages)
        return pa.table({"code": words, "class": mine.astype(np.int32)})


def _row_sums(rows: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of ``rows[at]``, each of its size (at least one): first rows of all runs,
    then second ones, so each step adds a block of rows."""
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    out = np.empty((len(sizes), rows.shape[1]))
    total = rows[at[first]]
    longer = np.searchsorted(-sizes[order], -np.arange(1, sizes.max(initial=1)), "left").tolist()
    for step, size in enumerate(longer, 1):
        total[:size] += rows[at[first[:size] + step]]
    out[order] = total
    return out


def _mover(plan: _Buckets, shared, turn: int):
    return lambda static, messages: plan.choose(static, messages, *shared.value, turn)


def cluster(texts: DataFrame, numbering: Numbering, distinct: int, classes: int):
    """(class of each word of the vocabulary and of the end; code, class of all other
    words; the class-pair table).  ``distinct`` words are in the texts; their number,
    not that of the cluster's partitions, gives the buckets."""
    spark, end, movable = texts.sparkSession, numbering.first_shape, numbering.first_shape
    total, buckets = classes + 1, max(1, -(-(distinct - movable) // BUCKET_WORDS))
    plan = _Buckets(end, classes, buckets)
    dealt = dealt_pairs(texts, spark.sparkContext.broadcast(numbering), buckets)
    static = dealt.groupBy("bucket").applyInArrow(lambda t: plan.build(t), plan.static_ddl)
    # dealt once for all sweeps; what a lost executor held is counted again from the texts
    static = static.repartition(shuffle_partitions(spark), "bucket").persist(StorageLevel.DISK_ONLY)
    fixed = classes + np.arange(SHAPES + 1)
    try:
        pairs = pair_table(static, numbering.size)
        start = exchange(pairs, movable, fixed, classes) if movable else fixed
        vocabulary = np.concatenate((start[:movable], [total - 1]))
        return _sweeps(plan, static.where("bucket >= 0"), pairs, vocabulary, movable, numbering.end)
    finally:
        static.unpersist()


def _sweeps(plan: _Buckets, static: DataFrame, pairs: np.ndarray, vocabulary: np.ndarray, movable: int, last: int):
    spark, end, classes, total = static.sparkSession, plan.end, plan.classes, plan.total
    messages = written(static.groupBy("bucket").applyInArrow(lambda t: plan.first(t), plan.message_ddl), "classes")

    def met(function, ddl):
        return static.groupBy("bucket").cogroup(messages.groupBy("bucket")).applyInArrow(function, ddl)

    inside = np.r_[0:movable, last]
    best = None
    for turn in range(SWEEPS + 1):
        found = met(lambda x, y: plan.tables(x, y), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow().to_pandas()
        wide = np.zeros((end + 1 + total, end + 1 + total))  # the vocabulary, the end, and the classes of all others
        wide[: end + 1, : end + 1] = pairs[np.ix_(inside, inside)]
        wide[found["a"].to_numpy(np.int64), found["b"].to_numpy(np.int64)] = found["n"]
        others = np.concatenate(([total - 1], np.arange(total)))
        if turn and movable:
            vocabulary = exchange(wide, movable, others, classes, 1, vocabulary[:movable])[: movable + 1]
        member = np.eye(total)[np.concatenate((vocabulary[:movable], others))]
        table = member.T @ wide @ member
        height = _f(table).sum() - _f(table.sum(1)).sum() - _f(table.sum(0)).sum()
        if not len(found):
            best = (height, vocabulary, messages, table)
            break
        if turn and height <= best[0] + LEAST_RISE * abs(best[0]):
            if height > best[0]:
                best = (height, vocabulary, messages, table)
            break
        best = (height, vocabulary, messages, table)
        if turn == SWEEPS:
            break
        shared = spark.sparkContext.broadcast((table, vocabulary))

        messages = written(met(_mover(plan, shared, turn), plan.message_ddl), "classes")
    _, vocabulary, messages, table = best
    others = written(met(lambda x, y: plan.classes_of(x, y), "code long, class int"), "word_classes")
    return vocabulary, others, table


class ClassModel:
    """Class of each number, log10 transitions, and what emissions divide by."""

    def __init__(self, table: np.ndarray, end: int, class_n: np.ndarray, class_v: np.ndarray, once: np.ndarray):
        """table: the class-pair table; end: the class of the end; class_n, class_v: count
        and distinct words of each class; once: words seen once, by shape."""
        live = np.flatnonzero((class_v > 0) | (np.arange(len(table)) == end))
        self.number = np.full(len(table), -1, np.int64)  # empty classes go
        self.number[live] = np.arange(len(live))
        self.unknown = len(live) + np.arange(SHAPES)
        self.end_class = int(self.number[end])
        table = np.pad(table[np.ix_(live, live)], (0, SHAPES))
        room = np.concatenate((np.maximum(class_v[live], 1), np.ones(SHAPES)))
        unigram = table.sum(0) + ALPHA
        unigram[self.unknown] += once
        unigram /= unigram.sum()
        kinds, seen = (table > 0).sum(1), table.sum(1)
        weight = np.where(seen > 0, kinds, 1.0)[:, None]
        self.transitions = np.log10(np.maximum((table + weight * unigram) / (seen[:, None] + weight), 1e-300))
        self.divisor = np.log10(np.concatenate((class_n[live], np.zeros(SHAPES))) + ALPHA * room)

    def numbered(self, words: dict[bytes, int]):
        """Gives the words (word -> class), then the shapes, then the end their numbers."""
        self.numbering = Numbering(list(words))
        self.of = np.concatenate((self.number[np.array(list(words.values()), np.int64)], self.unknown, [self.end_class]))


def learn(texts: DataFrame, vocabulary: int = VOCABULARY, classes: int = CLASSES):
    """(counts and classes of all words as a written table, ClassModel, N, V, {word: n}
    of the most frequent words) of ``texts``."""
    spark = texts.sparkSession
    bounded_batches(spark)
    counts = written(word_counts(texts), "word_counts")
    n_all, v_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    first = counts.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(vocabulary).toArrow().to_pandas()
    numbering = Numbering([w.encode() for w in first["word"]])
    classes = max(1, min(classes, numbering.first_shape))
    own, others, table = cluster(texts, numbering, int(v_all), classes)
    known = spark.sparkContext.broadcast(dict(numbering.table) | {b"": numbering.first_shape})

    def coded(batches):
        for batch in batches:
            words = [w.encode() for w in batch.column("word").to_pylist()]
            codes = [known.value.get(w, -1) for w in words]
            codes = [rare_code(w) if c < 0 else c for w, c in zip(words, codes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(codes, pa.int64()), pa.array(shapes(words))],
                names=["word", "n", "code", "shape"],
            )

    frequent = spark.createDataFrame([(i, int(c)) for i, c in enumerate(own)], "code long, class int")
    with_code = counts.mapInArrow(coded, "word string, n long, code long, shape int")
    assigned = written(with_code.join(others.unionByName(frequent), "code").select("word", "n", "class", "shape"), "classed_words")
    class_n, class_v, once = np.zeros(len(table)), np.zeros(len(table)), np.zeros(SHAPES)
    sums = F.sum("n").alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("once")
    for r in assigned.groupBy("class", "shape").agg(*sums).collect():
        class_n[r["class"]] += r["n"]
        class_v[r["class"]] += r["v"]
        once[r["shape"]] += r["once"] if r["class"] != int(own[-1]) else 0
    model = ClassModel(table, int(own[-1]), class_n, class_v, once)
    top = assigned.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(TABLE_WORDS).toArrow().to_pandas()
    words = [w.encode() for w in top["word"]]
    model.numbered(dict(zip(words, top["class"].tolist(), strict=True)))
    counted = dict(zip(words, top["n"].tolist(), strict=True))
    if ends := int(class_n[int(own[-1])]):
        counted[END.encode()] = ends
    return assigned, model, int(n_all), int(v_all), counted


def score(docs: DataFrame, training: DataFrame, vocabulary: int = VOCABULARY, classes: int = CLASSES) -> DataFrame:
    """The rows of ``docs`` (columns key, text) as key, n_tokens, n_known,
    train_tokens, base_score, score; the model is learnt from ``training`` (text)."""
    assigned, model, n_all, v_all, table = learn(training, vocabulary, classes)
    context = docs.sparkSession.sparkContext
    times_of = np.array([table[w] for w in model.numbering.table], np.int64)
    shared = context.broadcast((model, times_of, table.get(END.encode())))  # bounded by CLASSES and TABLE_WORDS
    total = len(model.divisor)

    def make():
        from pyspark import TaskContext

        model, times_of, ends = shared.value
        row = TaskContext.get().partitionId() << 33  # ids may repeat or be null: rows are numbered
        end, of = model.numbering.end, model.of
        logs = np.full(end + 1, np.log10(ALPHA))  # an end that no training text has is known by class, not by count
        logs[:len(times_of)] = np.log10(times_of + ALPHA)
        if ends:
            logs[end] = np.log10(ends + ALPHA)

        def batch_rows(batch):
            nonlocal row
            texts = Words([_cut(batch.column("text"))], model.numbering.cut)
            number, place, table = texts.looked_up()
            found = _with_ends(table[number], texts.per_text(), end)
            stops, doc = np.cumsum(texts.per_text() + 1), np.repeat(np.arange(texts.texts), texts.per_text())
            starts = np.append(0, stops[:-1])
            cls = of[found]
            late = np.flatnonzero(table[number] < 0)  # words not in the table: once for each document
            rare = np.flatnonzero(table < 0)
            rare = rare[np.argsort(place[rare])]  # as they come in the texts
            table[rare] = np.arange(len(rare))
            each, where, times = np.unique(doc[late] << 32 | table[number[late]], return_inverse=True, return_counts=True)
            cuts = np.searchsorted(each, np.arange(texts.texts + 1) << 32).astype(np.int32)
            cls[late + doc[late]] = total + where - cuts[doc[late]]
            each &= 0xFFFFFFFF
            strings = texts.strings(place[rare])
            words = pa.array(strings, pa.binary()).cast(pa.string()).take(pa.array(each))
            kinds = model.unknown[shapes(strings)].astype(np.int32)[each]
            words, times, unknown = (pa.ListArray.from_arrays(cuts, x) for x in (words, pa.array(times), pa.array(kinds)))
            before = np.concatenate(([model.end_class], cls[:-1]))  # each text closes with the end, which begins the next
            there = cls < total
            both = there & (before < total)
            fixed = np.zeros(len(cls))
            fixed[both] = model.transitions[before[both], cls[both]]
            fixed[there] -= model.divisor[cls[there]]
            counted = np.where(there, logs[found], 0.0)
            late = np.flatnonzero(~both)
            cuts = np.searchsorted(late, np.concatenate((starts, stops[-1:])))
            side = np.stack((before[late], cls[late])).astype(np.int32)
            links = [side[:, a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            row += texts.texts
            return {
                "row": np.arange(row - texts.texts, row), "key": batch.column("key"), "n_tokens": stops - starts,
                "n_known": np.add.reduceat(there.astype(np.int64), starts) - (not ends),
                "model_part": np.add.reduceat(fixed, starts), "count_part": np.add.reduceat(counted, starts), "links": links,
                "words": words, "times": times, "unknown": unknown,
            }

        return batch_rows

    schema = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("model_part", pa.float64()),
                        ("count_part", pa.float64()), ("links", pa.binary()), ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int64())),
                        ("unknown", pa.list_(pa.int32()))])
    parts = written(docs.mapInArrow(
        per_batch(make, schema),
        "row long, key long, n_tokens long, n_known long, model_part double, count_part double, links binary,"
        " words array<string>, times array<long>, unknown array<int>",
    ), "scored")
    rare = parts.select("row", F.posexplode(F.arrays_zip("words", "unknown")).alias("pos", "x")).select(
        "row", F.col("x.words").alias("word"), (F.col("pos").cast("long") * SHIFT + F.col("x.unknown")).alias("place")
    )
    number = F.array(*[F.lit(int(x)) for x in model.number])
    # words are distinct there, so its share of a partition is a hash table; the documents' rows need no sort
    known = assigned.select("word", "n", F.get(number, F.col("class")).alias("class")).hint("shuffle_hash")
    at = F.col("place") - F.pmod("place", F.lit(SHIFT))
    entry = F.struct((at + F.coalesce("class", F.pmod("place", F.lit(SHIFT)))).alias("place"), F.coalesce("n", F.lit(0)).alias("n"))
    per_row = rare.join(known, "word", "left").groupBy("row").agg(F.collect_list(entry).alias("found"))  # of one document

    def finish():
        model = shared.value[0]

        def batch_rows(batch):
            n_known, model_part, count_part = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("n_known", "model_part", "count_part"))
            blobs, counts, lists = batch.column("links"), batch.column("times"), batch.column("found")
            for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist():
                entries, times = lists[i].values, counts[i].values.to_numpy()
                place, found = entries.field(0).to_numpy(), entries.field(1).to_numpy()
                cls, n = np.empty((2, len(times)), np.int64)
                cls[place // SHIFT], n[place // SHIFT] = place % SHIFT, found
                of = np.concatenate((np.arange(total), cls))
                a, b = of[np.frombuffer(blobs[i].as_py(), np.int32).reshape(2, -1)]
                n_known[i] += times[n > 0].sum()
                count_part[i] += (times * np.log10(n + ALPHA)).sum()
                model_part[i] += model.transitions[a, b].sum() - (times * model.divisor[cls]).sum()
            return {"key": batch.column("key"), "n_tokens": batch.column("n_tokens"), "n_known": n_known, "model_part": model_part, "count_part": count_part}

        return batch_rows

    divisor = float(np.log10(n_all + ALPHA * (v_all + 1)))
    out = pa.schema([schema.field(c) for c in ("key", "n_tokens", "n_known", "model_part", "count_part")])
    whole = parts.select("row", "key", "n_tokens", "n_known", "model_part", "count_part", "links", "times").join(per_row, "row", "left")
    return whole.mapInArrow(
        per_batch(finish, out), "key long, n_tokens long, n_known long, model_part double, count_part double"
    ).select(
        "key", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("count_part") - F.col("n_tokens") * F.lit(divisor)).alias("base_score"),
        (F.col("count_part") + F.col("model_part")).alias("score"),
    )


def score_documents(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: learnt
    from the rows whose id remainder is not ``held``.  perplexity is 10 to the power of
    -score / n_tokens."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        (id_remainder(F.col("doc_id"), folds) == held).alias("held_out"),
    )
    keyed = rows.select(F.col("doc_id").alias("key"), "text")
    scored = score(keyed, rows.where(~F.col("held_out")).select("text"))
    return scored.select(
        F.col("key").alias("doc_id"), (id_remainder(F.col("key"), folds) == held).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
