"""Suffix-array dedup: maximal repeats from a common-prefix interval tree.

A byte goes when a string of ``min_bytes`` bytes over it also starts in a
document with a smaller id.  Texts are UTF-8 bytes; matches never cross documents.

*Partitioning.*  The suffix array is cut so that suffixes that share their first
``min_bytes`` bytes always meet: the anchor of a suffix is the leftmost
smallest-hashed ``K``-gram of those bytes.  Neighbouring suffixes mostly share
their anchor, so they travel as one window of text.

1. Every part of the corpus sends the distinct hashes of its anchors; an anchor
   that no second document has can start no repeat.
2. For the others each part sends its *distinct* windows, each once, with the
   smallest document id that holds it in this part.  A passage found in a third of all
   documents is one window per part.  An anchor with over ``HOT_WINDOWS`` distinct
   windows (a common string in ever other surroundings) is not sent to one task: its
   windows are cut into the single strings of ``min_bytes``, dealt by their own hash.
3. A task builds the enhanced suffix array (sorted suffixes and their common
   prefix lengths) of the windows of its anchors, stack-scans it into intervals of
   suffixes with a common prefix of at least ``min_bytes``, keeps the intervals whose
   members differ in the byte to their left (else the interval one byte to the left
   says the same, and more), and returns each with *all* its members: a maximal
   repeat group.  What a window's start has to its left lies in another anchor's
   windows, so a start always counts as different.
4. The groups go back to the parts, which mark the occurrences in documents with an
   id above the group's smallest.

A window is less than twice ``min_bytes`` long, so a suffix is in at most
``min_bytes`` nested intervals and what is returned is linear in the windows.
Longer repeats come out as overlapping groups of neighbouring anchors.

Null texts are empty; documents shorter than ``min_bytes`` keep every byte.
Rows that repeat a doc_id are not earlier than each other, so they take nothing
from each other.  A null id is the smallest.  An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlane.llm.common import bounded_batches, shuffle_partitions, utf8_buffers

MIN_BYTES = 50
K = 16  # bytes of an anchor
CHUNK = 1 << 16  # bytes hashed at a time: what a core's cache holds
KEPT, SPANS = "kept_bytes", "removed_spans"  # names of the added columns
HOT_WINDOWS = 50_000  # distinct windows of one anchor above which it is split; changes no result
NO_ID = np.iinfo(np.int64).min
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
LOW = np.uint64((1 << 20) - 1)  # bits of a key that hold a position in a chunk


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the K bytes (a power of two) from each position."""
    h, factor, n = raw.astype(np.uint64) + np.uint64(1), ODD, 1
    while n < K:
        h = h[:-n] * factor + h[n:]
        with np.errstate(over="ignore"):
            factor = factor * factor
        n *= 2
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


def anchor_runs(raw: np.ndarray, offsets: np.ndarray, min_bytes: int):
    """Yields (hash of the anchor, first position, positions, row, hash of the
    window) arrays: the maximal runs of positions of one document whose next
    ``min_bytes`` bytes have the same anchor."""
    wide = min_bytes - K + 1
    step = CHUNK - min_bytes
    end_all = int(offsets[-1])
    for at in range(int(offsets[0]), max(int(offsets[0]), end_all - min_bytes + 1), step):
        part = raw[at:min(at + CHUNK - 1, end_all)]
        h = gram_hashes(part)
        m, s = (h & ~LOW) | np.arange(len(h), dtype=np.uint64), 1
        while s * 2 <= wide:
            m = np.minimum(m[:-s], m[s:])
            s *= 2
        if s < wide:
            m = np.minimum(m[:s - wide], m[wide - s:])
        anchor = (m[:step] & LOW).astype(np.int64)
        # rows whose documents touch this chunk
        lo = int(np.searchsorted(offsets, at, "right")) - 1
        hi = int(np.searchsorted(offsets, at + len(anchor) + min_bytes, "left"))
        inner = offsets[lo + 1:hi] - at  # document ends in reach of the chunk
        for e in inner.tolist():  # positions too near their document's end start nothing
            anchor[max(0, e - min_bytes + 1):e] = -1
        cut = np.zeros(len(anchor) + 1, bool)
        cut[0] = cut[-1] = True
        cut[1:-1] = anchor[1:] != anchor[:-1]
        cut[inner[(inner > 0) & (inner < len(anchor))]] = True
        bounds = np.flatnonzero(cut)
        first, n = bounds[:-1], np.diff(bounds)
        good = anchor[first] >= 0
        first, n = first[good], n[good]
        row = np.searchsorted(offsets, first + at, "right") - 1
        window = (h[first] * ODD + h[first + n - 1 + min_bytes - K]) * ODD + n.astype(np.uint64)
        yield h[anchor[first]], first + at, n, row, window


def all_runs(raw, offsets, min_bytes):
    found = list(anchor_runs(raw, offsets, min_bytes))
    if not found:
        none, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return none, at, at, at, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def slices(raw: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """(n, width) bytes from each start; beyond the end, zeros."""
    padded = np.concatenate((raw, np.zeros(width, np.uint8)))
    return np.lib.stride_tricks.sliding_window_view(padded, width)[starts]


def sort_rows(rows: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Lexicographic order of equal-width byte rows; ``more`` are keys after the
    bytes, most significant first."""
    width = -(-rows.shape[1] // 8) * 8
    if rows.shape[1] < width:
        rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    return np.lexsort((*more[::-1], *words.T[::-1]))


def prefix_lengths(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it, at most either's length."""
    differ = rows[1:] != rows[:-1]
    same = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.concatenate(([0], np.minimum(same, np.minimum(lengths[1:], lengths[:-1])))) if len(rows) else np.zeros(0, int)


def intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """(depth, first, end) of every interval of an enhanced suffix array whose
    common prefix has at least ``least`` bytes, by one stack scan.  lcp[i] belongs to
    suffixes i - 1 and i; lcp[0] is ignored."""
    out, stack = [], []  # stack: (depth, first), depths rising
    for i in range(1, len(lcp) + 1):
        depth, first = (lcp[i] if i < len(lcp) else 0), i - 1
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            out.append((top, first, i))
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return out


def repeat_groups(windows: np.ndarray, lengths: np.ndarray, starts: np.ndarray, min_bytes: int):
    """Maximal repeats among distinct ``windows`` (n, width) of ``lengths`` bytes with
    ``starts`` suffix positions each.  Returns (depth, members) with members a list
    of arrays: suffix -> (window, position).  Windows that share no start with
    another are in no group."""
    n = int(starts.sum())
    if not n:
        return []
    window = np.repeat(np.arange(len(windows)), starts)
    place = np.arange(n) - np.repeat(np.cumsum(starts) - starts, starts)
    # suffixes whose first bytes no other window has are in no interval
    width = windows.shape[1]
    at, h, key = window * width + place, gram_hashes(windows.ravel()), np.zeros(n, np.uint64)
    for step in [*range(0, min_bytes - K, K), min_bytes - K]:
        key = key * ODD + h[at + step]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    shared = np.zeros(n, bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    window, place, at = window[shared], place[shared], at[shared]
    if not len(window):
        return []
    size = lengths[window] - place
    text = slices(windows.ravel(), at, width)
    text[np.arange(width) >= size[:, None]] = 0
    order = sort_rows(text, size)
    window, place, size, text = window[order], place[order], size[order], text[order]
    lcp = prefix_lengths(text, size)
    # byte to the left; a window's start has -1 - (own number): different from all others
    before = windows.ravel()[np.maximum(window * width + place - 1, 0)].astype(np.int64)
    left = np.where(place > 0, before, -1 - np.arange(len(place)))
    breaks = np.flatnonzero(lcp < min_bytes)
    ends = np.concatenate((breaks[1:], [len(lcp)]))
    diverse = np.zeros(len(left), bool)
    diverse[1:] = left[1:] != left[:-1]
    seen = np.concatenate(([0], np.cumsum(diverse)))
    out = []
    keep = (ends - breaks > 1) & (seen[ends] > seen[np.minimum(breaks + 1, len(left))])
    for lo, hi in zip(breaks[keep].tolist(), ends[keep].tolist(), strict=True):
        for depth, a, b in intervals(lcp[lo:hi].tolist(), min_bytes):
            a, b = a + lo, b + lo
            if seen[b] > seen[a + 1]:  # two neighbours differ to the left
                out.append((depth, window[a:b], place[a:b]))
    return out


def _by_part(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, the other columns as one struct, and a part by doc_id."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0).alias("none")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.struct(*others).alias("others"),
    )
    return rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")).repartition(parts, "part")


def _bytes(*arrays) -> list[bytes]:
    """Each array as compressed bytes: a shuffle's own blocks are too small to find
    what repeats in a window's text."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return [pack(np.ascontiguousarray(a).data.cast("B") if a.size else b"") for a in arrays]


def _from(blobs, kind) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(b"".join(map(unpack, blobs)), kind)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _fields(**kinds) -> pa.Schema:
    return pa.schema([(k, {"int": pa.int32(), "binary": pa.binary()}[v]) for k, v in kinds.items()])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)


def _first_of_equal(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which sorted rows differ from the one before."""
    return np.concatenate(([True], (text[1:] != text[:-1]).any(1) | (size[1:] != size[:-1])))


def _expand(groups_of: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For every entry of ``owner`` every row of ``groups_of`` (sorted, below n) of
    the same value: (index in owner, index in groups_of)."""
    per = np.bincount(groups_of, minlength=n)
    begin = np.cumsum(per) - per
    times = per[owner]
    back = np.repeat(np.arange(len(owner)), times)
    return back, np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + begin[owner[back]]


def _split(key: np.ndarray):
    """(value, indices) for each value of ``key``."""
    order = np.argsort(key, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        if len(own):
            yield int(key[own[0]]), own


class _Passes:
    """The four steps over Arrow tables; see the module's docstring."""

    anchor_rows = _fields(bucket="int", part="int", hashes="binary", several="binary", kinds="binary")
    shared_rows = _fields(part="int", hashes="binary", hot="binary")
    window_rows = _fields(kind="int", target="int", part="int", a="binary", b="binary", c="binary", d="binary", e="binary")
    group_rows = _fields(kind="int", part="int", a="binary", b="binary", c="binary", d="binary")

    def __init__(self, min_bytes: int, buckets: int):
        self.min_bytes, self.buckets = min_bytes, buckets
        self.width = 2 * min_bytes - K  # of the longest window

    def scan(self, tbl: pa.Table):
        # equal rows are interchangeable, so row numbers mean the same in every pass
        tbl = tbl.combine_chunks().sort_by([("doc_id", "ascending"), ("text", "ascending")])
        raw, offsets = utf8_buffers(tbl.column("text"))
        ids = np.array([NO_ID if v is None else v for v in tbl.column("doc_id").to_pylist()], np.int64)
        return tbl, raw, offsets, ids

    def bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def anchors(self, tbl: pa.Table) -> pa.Table:
        tbl, raw, offsets, ids = self.scan(tbl)
        h, _, _, row, window = all_runs(raw, offsets, self.min_bytes)
        if not len(h):
            return self.anchor_rows.empty_table()
        order = np.lexsort((window, h))
        h, doc, window = h[order], ids[row[order]], window[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        first = np.flatnonzero(new)
        several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
        other = new | np.concatenate(([True], window[1:] != window[:-1]))
        kinds = np.minimum(np.add.reduceat(other.astype(np.int64), first), 0xFFFF).astype(np.uint16)
        h, part = h[first], tbl.column("part")[0].as_py()
        return _rows(self.anchor_rows, [
            (b, part, *_bytes(h[own], several[own], kinds[own])) for b, own in _split(self.bucket(h))])

    def shared(self, tbl: pa.Table) -> pa.Table:
        mine = [_from([x], np.uint64) for x in tbl.column("hashes").to_pylist()]
        several, kinds = (_from(tbl.column(c).to_pylist(), t) for c, t in (("several", bool), ("kinds", np.uint16)))
        _, where, n = np.unique(np.concatenate(mine), return_inverse=True, return_counts=True)
        keep = n > 1
        keep[where[several]] = True
        hot = np.bincount(where, kinds) > HOT_WINDOWS
        cuts = np.cumsum([len(x) for x in mine])[:-1]
        kept, split = np.split(keep[where], cuts), np.split(hot[where], cuts)
        parts = tbl.column("part").to_pylist()
        return _rows(self.shared_rows, [
            (p, *_bytes(x[k], s[k])) for p, x, k, s in zip(parts, mine, kept, split, strict=True) if k.any()])

    def windows(self, tbl: pa.Table, shared: pa.Table) -> pa.Table:
        """Kind 0, to a bucket: distinct windows.  Kind 1, to this part: their places."""
        if not tbl.num_rows or not shared.num_rows:
            return self.window_rows.empty_table()
        tbl, raw, offsets, ids = self.scan(tbl)
        h, first, n, row, _ = all_runs(raw, offsets, self.min_bytes)
        wanted, hot = (_from(shared.column(c).to_pylist(), t) for c, t in (("hashes", np.uint64), ("hot", bool)))
        order = np.argsort(wanted)
        wanted, hot = wanted[order], hot[order]
        at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
        hit = wanted[at] == h
        h, first, n, row, hot = h[hit], first[hit], n[hit], row[hit], hot[at[hit]]
        if hot.any():
            h, first, n, row = self.singles(raw, h, first, n, row, hot)
        part, rows, count = tbl.column("part")[0].as_py(), [], 0
        number = np.empty(len(h), np.int32)  # of each place's distinct window in this part
        for b, own in _split(self.bucket(h)):
            text, size = slices(raw, first[own], self.width), n[own] + self.min_bytes - 1
            text[np.arange(self.width) >= size[:, None]] = 0
            order = sort_rows(text, size)
            text, size, doc = text[order], size[order], ids[row[own[order]]]
            new = _first_of_equal(text, size)
            at = np.flatnonzero(new)
            number[own[order]] = count + np.cumsum(new) - 1
            body = text[at][np.arange(self.width) < size[at][:, None]]
            names = np.arange(count, count + len(at), dtype=np.int32)
            low, high = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
            rows.append((0, b, part, *_bytes(body, size[at].astype(np.uint8), names, low, high)))
            count += len(at)
        rows.append((1, part, part, *_bytes(number, np.diff(first, prepend=0)), b"", b"", b""))
        return _rows(self.window_rows, rows)

    def singles(self, raw, h, first, n, row, hot):
        """Cuts the runs of hot anchors into single positions, dealt by the hash of
        their bytes; in the order of the text, as before."""
        times = np.where(hot, n, 1)
        run = np.repeat(np.arange(len(n)), times)
        inside = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
        at, single = first[run] + inside, hot[run]
        words = np.pad(slices(raw, at[single], self.min_bytes), ((0, 0), (0, -self.min_bytes % 8))).view(np.uint64)
        own = h[run]
        mixed = np.zeros(len(words), np.uint64)
        for word in words.T:
            mixed = (mixed ^ word) * MIX
            mixed ^= mixed >> np.uint64(29)
        own[single] = mixed
        return own, at, np.where(single, 1, n[run]), row[run]

    def groups(self, tbl: pa.Table) -> pa.Table:
        """Kind 1 passes.  Kind 0: the repeat groups of a bucket, back to the parts of
        their members as (window, start, end, smallest id)."""
        c = tbl.to_pydict()
        if c["kind"][0] == 1:
            return _rows(self.group_rows, [(1, *x, b"", b"") for x in zip(c["part"], c["a"], c["b"], strict=True)])
        sizes = [_from([x], np.uint8) for x in c["b"]]
        size = np.concatenate(sizes).astype(np.int64)
        text = np.zeros((len(size), self.width), np.uint8)
        text[np.arange(self.width) < size[:, None]] = _from(c["a"], np.uint8)
        number, low, high = _from(c["c"], np.int32), _from(c["d"], np.int64), _from(c["e"], np.int64)
        part = np.repeat(np.array(c["part"], np.int64), [len(x) for x in sizes])
        order = sort_rows(text, size)
        text, size, number, low, high, part = (x[order] for x in (text, size, number, low, high, part))
        new = _first_of_equal(text, size)
        at = np.flatnonzero(new)
        least, most = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        text, size, own = text[at], size[at], np.cumsum(new) - 1
        copies = np.flatnonzero(least < most)  # copies of one window: the whole of it repeats
        found = [(copies, np.zeros_like(copies), size[copies], least[copies])]
        for depth, w, place in repeat_groups(text, size, size - self.min_bytes + 1, self.min_bytes):
            smallest = least[w].min()
            later = most[w] > smallest
            w, place = w[later], place[later]
            found.append((w, place, place + depth, np.full(len(w), smallest)))
        w, start, end, smallest = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(w, kind="stable")
        w, start, end, smallest = w[order], start[order], end[order], smallest[order]
        copy, group = _expand(w, own, len(at))
        live = high[copy] > smallest[group]
        copy, group = copy[live], group[live]
        rows = []
        for p, mine in _split(part[copy]):
            g = group[mine]
            rows.append((0, p, *_bytes(number[copy[mine]], start[g].astype(np.uint8), end[g].astype(np.uint8), smallest[g])))
        return _rows(self.group_rows, rows)

    def spans(self, tbl: pa.Table, hits: pa.Table):
        """The sorted table, its buffers, and the maximal removed runs: row, start
        and end as positions in the buffer."""
        tbl, raw, offsets, ids = self.scan(tbl)
        c = hits.to_pydict()
        none = np.zeros(0, np.int64)
        if 0 not in c["kind"] or 1 not in c["kind"]:
            return tbl, raw, offsets, none, none, none
        places = c["kind"].index(1)
        number, first = _from([c["a"][places]], np.int32), np.cumsum(_from([c["b"][places]], np.int64))
        row = np.searchsorted(offsets, first, "right") - 1
        got = [i for i, k in enumerate(c["kind"]) if k == 0]
        w, start, end, smallest = (
            _from([c[k][i] for i in got], t) for k, t in (("a", np.int32), ("b", np.uint8), ("c", np.uint8), ("d", np.int64))
        )
        order = np.argsort(w, kind="stable")
        w, start, end, smallest = w[order], start[order], end[order], smallest[order]
        place, group = _expand(w, number, int(number.max()) + 1)
        later = ids[row[place]] > smallest[group]
        place, group = place[later], group[later]
        if not len(place):
            return tbl, raw, offsets, none, none, none
        a, b, r = first[place] + start[group], first[place] + end[group], row[place]
        order = np.argsort(a, kind="stable")
        a, b, r = a[order], b[order], r[order]
        reach = np.maximum.accumulate(b)
        begin = np.flatnonzero(np.concatenate(([True], (a[1:] > reach[:-1]) | (r[1:] != r[:-1]))))
        return tbl, raw, offsets, r[begin], a[begin], np.maximum.reduceat(b, begin)


def whole_characters(raw: np.ndarray, start: np.ndarray, end: np.ndarray, offsets_end: np.ndarray):
    """Spans shrunk to whole characters; ``offsets_end`` is where each one's document ends."""
    padded = np.concatenate((raw, np.zeros(1, np.uint8)))
    inside = lambda at: padded[at] & 0xC0 == 0x80
    for _ in range(3):  # a character has at most three bytes after its first
        start = start + (inside(start) & (start < end))
        end = end - (inside(end) & (end < offsets_end) & (end > start))
    return start, end


def _cut(docs: DataFrame, min_bytes: int, characters: bool) -> DataFrame:
    """doc_id, text, others (a struct of the other columns), kept and spans; with
    ``characters`` the spans are shrunk to whole characters, kept is a string, and
    text is left out."""
    bounded_batches(docs.sparkSession)
    parts = shuffle_partitions(docs.sparkSession)
    steps = _Passes(min_bytes, 4 * parts)
    texts = _by_part(docs, parts)  # one exchange, reused by the three passes over the texts

    anchors = texts.groupBy("part").applyInArrow(lambda t: steps.anchors(t), _ddl(steps.anchor_rows))
    shared = anchors.groupBy("bucket").applyInArrow(lambda t: steps.shared(t), _ddl(steps.shared_rows))
    windows = texts.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(
        lambda t, s: steps.windows(t, s), _ddl(steps.window_rows))
    groups = windows.groupBy("kind", "target").applyInArrow(lambda t: steps.groups(t), _ddl(steps.group_rows))

    kept_type, kept_arrow = (T.StringType(), pa.string()) if characters else (T.BinaryType(), pa.binary())
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [f for f in texts.schema.fields if f.name != "part" and not (characters and f.name == "text")]
    out = T.StructType([*fields, T.StructField("kept", kept_type), T.StructField("spans", T.ArrayType(span))])
    left_out = ["part", "text"] if characters else ["part"]

    def cut(tbl: pa.Table, hits: pa.Table) -> pa.Table:
        if not tbl.num_rows:
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            empty = tbl.drop_columns(left_out).append_column("kept", pa.array([], kept_arrow))
            return empty.append_column("spans", pa.array([], span_type))
        tbl, raw, offsets, row, a, b = steps.spans(tbl, hits)
        if characters:
            a, b = whole_characters(raw, a, b, offsets[row + 1])
        stays = np.ones(len(raw), bool)
        for s, e in zip(a.tolist(), b.tolist(), strict=True):
            stays[s:e] = False
        gone = np.bincount(row, b - a, len(offsets) - 1).astype(np.int64)
        new = np.concatenate(([0], np.cumsum(np.diff(offsets) - gone)))
        lo, hi = int(offsets[0]), int(offsets[-1])
        buffers = [None, pa.py_buffer(new.astype(np.int64)), pa.py_buffer(raw[lo:hi][stays[lo:hi]])]
        kept = pa.Array.from_buffers(pa.large_binary(), len(new) - 1, buffers).cast(pa.binary()).cast(kept_arrow)
        counts = np.bincount(row, minlength=len(offsets) - 1)
        runs = pa.StructArray.from_arrays([pa.array(a - offsets[row]), pa.array(b - offsets[row])], ["start", "end"])
        spans = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), runs)
        return tbl.drop_columns(left_out).append_column("kept", kept).append_column("spans", spans)

    return texts.groupBy("part").cogroup(groups.groupBy("part")).applyInArrow(cut, out)


def _columns(docs: DataFrame, **own) -> dict:
    """The columns of ``docs`` by name, out of ``_cut``; ``own`` replaces some."""
    named = {c: F.col(f"others.`{c}`").alias(c) for c in docs.columns if c not in ("doc_id", "text")}
    named |= {"doc_id": F.col("doc_id"), "text": F.col("text")} | {c: v.alias(c) for c, v in own.items()}
    return {c: named[c] for c in [*docs.columns, *[c for c in own if c not in docs.columns]]}


def deduplicate(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The columns of ``docs`` (text as given, null as empty) with ``KEPT`` (binary:
    the bytes that stay) and ``SPANS`` (sorted structs start, end: the maximal runs
    that go) per row.  Columns of ``docs`` that have these two names are replaced."""
    done = _cut(docs, min_bytes, characters=False)
    return done.select(*_columns(docs, **{KEPT: F.col("kept"), SPANS: F.col("spans")}).values())


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with what repeats removed from text, by whole characters, and n_chars
    (where it is) counted anew; all rows and other columns as they are."""
    own, kinds = {"text": F.col("kept")}, dict(docs.dtypes)
    if "n_chars" in kinds:
        own["n_chars"] = F.length("kept").cast(kinds["n_chars"])
    return _cut(docs, min_bytes, characters=True).select(*_columns(docs, **own).values())
