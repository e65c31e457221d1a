"""SimHash near-duplicates found by pivot distance tables.

A 64-bit fingerprint is taken of the word shingles of every document.  Copies
share a fingerprint, so they collapse to one class before any comparison.

*Where pairs meet.*  Two fingerprints within ``max_bits`` bits agree on a whole
block when the 64 bits are cut into ``max_bits + 1`` blocks, and, after that
block, on a whole sub-block of the rest cut the same way.  Every fingerprint is
dealt once to each (block, sub-block) key: a fixed number of rows each, no
cross join, and no pair is missed.

*How pairs are tested.*  Each fingerprint carries its pivot table row: the
Hamming distances to ``PIVOTS`` reference fingerprints.  By the triangle
inequality two fingerprints further apart than ``max_bits`` in any coordinate
are no pair; the survivors of the maximum coordinate difference are verified by
the exact distance.  A group is walked component by component: each popped
fingerprint is compared with those not yet reached, so a dense group of n near
copies costs about n comparisons and leaves n - 1 links, never all pairs.

Null and empty texts, and texts without a word, have fingerprint zero and link
like any other.  Fewer words than a shingle: the whole sequence is the shingle.
Repeated rows are one more member of their class.  Null ids form no class
representative unless every member's id is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import bounded_batches, doc_texts, per_batch, shuffle_partitions, written
from spendlane.llm.components import connected_components

PIVOTS = 32
SEED = 42


def fingerprint(text: bytes, words: int = 4, seed: int = SEED) -> int:
    """SimHash of lower-cased (A-Z) ``text`` over shingles of ``words`` words,
    repeats included; a bit is set if it is set in over half the hashes."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not parts:
        return 0
    if len(parts) <= words:
        hashes = [xxh64_intdigest(b" ".join(parts), seed)]
    else:
        line = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)
        hashes = [xxh64_intdigest(line[a:b], seed) for a, b in spans]
    total, h = np.zeros(64, np.int64), np.array(hashes, np.uint64)
    for at in range(0, len(h), 1 << 14):
        rows = h[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, also: str | None = None) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) per row, and a long column ``also``."""

    def make():
        def one(batch):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            out = {"doc_id": batch.column("doc_id"), "fp": fps}
            return out | {also: batch.column(also)} if also else out

        return one

    bounded_batches(docs.sparkSession)
    names = ["doc_id", "fp", *([also] if also else [])]
    schema = pa.schema([(n, pa.int64()) for n in names])
    return doc_texts(docs, also).mapInArrow(per_batch(make, schema), ", ".join(f"{n} long" for n in names))


def pivot_fingerprints(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: a fixed pseudo-random sequence."""
    return np.random.default_rng(2024).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def blocks(bits: list[int], n: int) -> list[list[int]]:
    return [list(map(int, part)) for part in np.array_split(np.array(bits), n)]


def _packed(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for i, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def meeting_keys(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """(n, keys) longs: for each fingerprint one key per block and sub-block."""
    n, keys = max_bits + 1, []
    for i, block in enumerate(blocks(list(range(64)), n)):
        rest = [b for b in range(64) if b not in set(block)]
        for j, sub in enumerate(blocks(rest, n)):
            value = _packed(fps, block + sub)
            tag = np.uint64((i * n + j) + 1)
            keys.append((value * np.uint64(n * n + 1) + tag).view(np.int64))
    return np.stack(keys, 1)


def linked(x: np.ndarray, y: np.ndarray, max_bits: int, pivots: np.ndarray) -> np.ndarray:
    """Which pairs (x, y) pass the pivot tables and are verified."""
    gap = np.abs(
        np.bitwise_count(x[:, None] ^ pivots).astype(np.int16) - np.bitwise_count(y[:, None] ^ pivots).astype(np.int16)
    ).max(1, initial=0)
    return (gap <= max_bits) & (np.bitwise_count(x ^ y) <= max_bits)


def local_links(fps: np.ndarray, max_bits: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """(index, index of its component's first member) for the members of ``fps``
    that have a link, found by pivot tables and verified by exact distance."""
    n = len(fps)
    if n < 2:
        return []
    coords = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)
    order = np.argsort(coords[:, 0], kind="stable")
    fps, coords = fps[order], coords[order]
    left = np.arange(n)  # not yet reached, sorted by the first coordinate
    links = []
    while len(left):
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            x = frontier.pop()
            first = coords[left, 0]
            lo = np.searchsorted(first, coords[x, 0] - max_bits, "left")
            hi = np.searchsorted(first, coords[x, 0] + max_bits, "right")
            near = left[lo:hi]
            for c in range(1, coords.shape[1], 8):  # a few coordinates at a time: most go at once
                if not len(near):
                    break
                gap = np.abs(coords[near, c:c + 8] - coords[x, c:c + 8]).max(1)
                near = near[gap <= max_bits]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= max_bits]
            if len(near):
                links += [(int(order[y]), int(order[root])) for y in near]
                frontier += near.tolist()
                left = left[~np.isin(left, near, assume_unique=True)]
    return links


def near_links(classes: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of ``classes`` (column fp) that
    span every component of fingerprints linked at ``max_bits`` bits or fewer."""
    n_keys = (max_bits + 1) ** 2
    pivots = pivot_fingerprints()

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            fps = batch.column("fp").to_numpy()
            keys = meeting_keys(fps.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(fps, n_keys))], names=["key", "fp"]
            )

    def link(batches):
        """Rows arrive sorted by key: each key's rows are read together, one key
        at a time."""
        rest_key, rest = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def edges(keys, fps):
            starts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1))
            sizes = np.diff(np.concatenate((starts, [len(keys)])))
            pair = starts[sizes == 2]  # most groups are pairs: all of them at once
            pair = pair[linked(fps[pair].view(np.uint64), fps[pair + 1].view(np.uint64), max_bits, pivots)]
            a, b = fps[pair + 1].tolist(), fps[pair].tolist()
            for s, m in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                group = fps[s:s + m]
                for y, root in local_links(group.view(np.uint64), max_bits, pivots):
                    a.append(int(group[y]))
                    b.append(int(group[root]))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate((rest_key, batch.column("key").to_numpy()))
            fps = np.concatenate((rest, batch.column("fp").to_numpy()))
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            rest_key, rest = keys[cut:], fps[cut:]
            if cut:
                yield edges(keys[:cut], fps[:cut])
        if len(rest_key):
            yield edges(rest_key, rest)

    dealt = classes.select("fp").mapInArrow(deal, "key long, fp long")
    parts = shuffle_partitions(classes.sparkSession)
    met = dealt.repartition(parts, "key").sortWithinPartitions("key")
    return met.mapInArrow(link, "a long, b long").distinct()


def component_of(rows: DataFrame, max_bits: int) -> DataFrame:
    """fp, first_id (smallest id of the fingerprint's rows) and component of every
    fingerprint of ``rows`` (doc_id, fp)."""
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    members = connected_components(near_links(classes, max_bits))  # node, component: linked classes only
    return classes.join(members.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id of
    the documents reachable over links, the row's own included."""
    rows = written(fingerprints(docs, words), "fingerprints")
    known = component_of(rows, max_bits)
    smallest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = known.join(smallest, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """Exactly one row of ``docs`` from each component: the one with the smallest id
    (null after all others), of several with that id the one with the smallest hash
    over all columns, of equal rows one."""
    columns = docs.columns
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    marked = docs.select("doc_id", "text", mark.alias("mark"))
    rows = written(fingerprints(marked, words, also="mark"), "fingerprints")
    component = component_of(rows, max_bits).select("fp", "component")
    # equal rows are counted first, combined map-side, so a hot component sends a row per task
    each = rows.join(component, "fp").groupBy("component", "doc_id", "mark").agg(F.count("*").alias("n"))
    best = each.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "n")).alias("best"))
    kept = written(best.select(F.col("best.doc_id").alias("_id"), F.col("best.mark").alias("_mark"), F.col("best.n").alias("_n")), "kept")

    def rows_of(chosen: DataFrame) -> DataFrame:
        return docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(chosen["_id"]) & (mark == chosen["_mark"]), "left_semi")

    repeated = kept.where("_n > 1")
    single = rows_of(kept.where("_n = 1"))
    return single if repeated.isEmpty() else single.unionByName(rows_of(repeated).dropDuplicates(columns))
