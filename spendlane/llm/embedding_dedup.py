"""Embedding near-dedup with randomised-rotation binary codes.

1. Equal vectors collapse to one class with a weight, so copies cost one row.
2. A bounded sample (``SAMPLE`` vectors or twice the number of cells, at most twice
   ``MAX_CELLS``) gives cell centres, from the densest places on, no two of them as close
   as a link.  Every class gets its nearest centre as home and visits the cells that may hold a vector linked to it: the component of a link's
   difference along two centres has a known spread, and ``PROBE`` of its standard
   deviations are allowed for.  A pair meets in the home cell of one of the two, and
   counts in one cell only.
3. Classes within half the angle of a link from their centre are its core: all of them
   link with one another by the triangle inequality, so a hot family of near copies is
   counted, never compared or listed.
4. Elsewhere members and visitors of a cell meet in tiles of bounded size.  A vector is
   rotated at random into ``code_bits`` dimensions; its code is the signs, its stored
   correction factor the inner product of the vector and its code.  A partner, rotated
   too and quantised to 4 bits with random rounding, meets codes by bit counts only;
   divided by the factor that is an unbiased estimate of the cosine, with a confidence
   interval of ``EPSILON`` standard deviations.  Pairs whose interval reaches the
   threshold are computed again exactly, in double precision; only those make links.
5. Tiles emit link counts and a spanning forest, never pairs.

Defined results: vectors that are null, zero, or hold a null or non-finite component
link with nothing and are their own component.  Shorter vectors count as zero beyond
their end.  Every row is a vector, also with a null or repeated id; a null id is never
the smallest unless all are null; ``kept`` compares null-safely.  Empty in, empty out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import written
from spendlane.llm.components import connected_components

CELL = 512  # classes of a cell, on average
SAMPLE = 512
MAX_CELLS = 4096  # centres; beyond 2 million classes cells grow and are cut into more tiles
TILE = 4096  # members, and partners, of a tile
BLOCK = 256  # partners scored at once
PROBE = 2.0
EPSILON = 5.0
SEED = 20
EDGE = 1e-6  # radians kept clear of rounding where no exact value is computed
TILE_SQL = "class long, links long, root long"


def takes_part(vec: Column) -> Column:
    """Whether a vector can link: no null or non-finite component, and not zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.coalesce(F.forall(vec, finite) & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, scaled by powers of two so that no square overflows."""
    at, flat = column.offsets.to_numpy(), column.flatten().to_numpy(zero_copy_only=False).astype(float)
    lengths = np.diff(at)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], lengths)] = flat
    _, power = np.frexp(np.abs(out).max(axis=1, initial=0.0))
    return np.ldexp(out, -power[:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def code_bits(width: int) -> int:
    return max(128, -(-width // 64) * 64)


def rotation(width: int) -> np.ndarray:
    """``width`` orthonormal random directions in ``code_bits`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(code_bits(width), width)))
    return (q * np.sign(np.diag(r))).T


def packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def encoded(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes and correction factors of rotated unit vectors."""
    return packed(rotated > 0), np.abs(rotated).sum(axis=1) / math.sqrt(rotated.shape[1])


class Partners:
    """Rotated vectors quantised to 4 bits with random rounding, as four bit planes."""

    def __init__(self, rotated: np.ndarray, rng: np.random.Generator):
        self.low = rotated.min(axis=1)
        self.step = np.maximum((rotated.max(axis=1) - self.low) / 15, 1e-12)
        level = np.floor((rotated - self.low[:, None]) / self.step[:, None] + rng.random(rotated.shape)).clip(0, 15).astype(np.uint8)
        self.planes = [packed(level >> j & 1) for j in range(4)]
        self.dims = rotated.shape[1]
        self.sum = self.step * level.sum(axis=1) + self.dims * self.low

    def estimates(self, at: slice, code: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines with the coded vectors, and half their confidence interval."""
        counted = np.zeros((self.planes[0][at].shape[0], len(code)), np.int32)
        for j, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                counted += np.bitwise_count(plane[at, w][:, None] & code[None, :, w]).astype(np.int32) << j
        ones = np.bitwise_count(code).sum(axis=1)
        low, step = self.low[at][:, None], self.step[at][:, None]
        raw = (2 * (step * counted + low * ones) - self.sum[at][:, None]) / math.sqrt(self.dims)
        spread = np.sqrt(np.maximum(1 - factor**2, 0)) / math.sqrt(self.dims - 1) + step / 2
        return raw / factor, EPSILON * spread / factor


def centres(sample: np.ndarray, most: int, threshold: float) -> np.ndarray:
    """Up to ``most`` unit vectors of the sample, those with the most links in it first,
    no two linked, each moved to the mean of the sample's vectors that link with it."""
    links = np.concatenate([((sample[a:a + 512] @ sample.T) >= threshold).sum(axis=1) for a in range(0, len(sample), 512)])
    kept = np.zeros((0, sample.shape[1]))
    for row in sample[np.argsort(-links, kind="stable")]:
        if len(kept) == most:
            break
        if not len(kept) or (kept @ row).max() < threshold:
            kept = np.vstack((kept, row))
    cos = sample @ kept.T
    home = cos.argmax(axis=1)
    near = cos[np.arange(len(sample)), home] >= threshold
    moved = np.zeros_like(kept)
    np.add.at(moved, home[near], sample[near])
    return unit(moved)


def assigner(centre: np.ndarray, width: int, threshold: float):
    """mapInArrow: home, core, visited cells, code and factor of every class."""
    angle = math.acos(threshold)
    allowed = math.tan(angle) * min(1.0, PROBE / math.sqrt(max(width - 1, 1)))
    apart = np.sqrt(np.maximum(2 - 2 * centre @ centre.T, 0))
    turn = rotation(width)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit(matrix(batch.column("vec"), width))
            cos = rows @ centre.T
            home = cos.argmax(axis=1)
            best = cos[np.arange(len(rows)), home]
            visits = best[:, None] - cos <= allowed * apart[home]
            visits[np.arange(len(rows)), home] = False
            code, factor = encoded(rows @ turn)
            at = np.append(0, visits.sum(axis=1).cumsum())
            yield pa.RecordBatch.from_arrays([
                batch.column("class"), batch.column("weight"), batch.column("vec"), pa.array(home, pa.int32()),
                pa.array(best >= math.cos(angle / 2 - EDGE)),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.nonzero(visits)[1], pa.int32())),
                pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor),
            ], names=["class", "weight", "vec", "home", "core", "visits", "code", "factor"])

    return run


class Forest:
    """Union-find over numbered nodes; roots are the smallest numbers."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(self.root, self.root[self.root]):
                self.root = self.root[self.root]


def exact_cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    lx, ly = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    out = np.empty(len(i))
    for a in range(0, len(i), 1 << 15):
        p, q = i[a:a + (1 << 15)], j[a:a + (1 << 15)]
        out[a:a + (1 << 15)] = np.einsum("ij,ij->i", x[p], y[q]) / (lx[p] * ly[q])
    return out


def tile(width: int, threshold: float):
    """applyInArrow: members of a cell against non-core members and visitors."""
    schema = pa.schema([("class", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        cell = key[0].as_py()
        role = table.column("role").to_numpy()
        is_member, is_partner = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        if not len(is_member) or not len(is_partner):
            return schema.empty_table()
        table = table.combine_chunks()
        rows = matrix(table.column("vec").chunk(0), width)
        cls, weight = table.column("class").to_numpy(), table.column("weight").to_numpy()
        home, core = table.column("home").to_numpy(), table.column("core").to_numpy()
        visits = table.column("visits").chunk(0)
        stride = np.int64(MAX_CELLS + 1)
        seen_in = np.sort(np.repeat(np.arange(len(visits)), np.diff(visits.offsets.to_numpy())) * stride + visits.flatten().to_numpy())
        words = code_bits(width) // 64
        code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(-1, words)[is_member]
        factor = table.column("factor").to_numpy()[is_member]
        partners = Partners(unit(rows[is_partner]) @ rotation(width), np.random.default_rng([SEED, cell]))
        nodes, node = np.unique(cls, return_inverse=True)
        links, forest = np.zeros(len(nodes)), Forest(len(nodes))
        for lo in range(0, len(is_partner), BLOCK):
            at = slice(lo, lo + BLOCK)
            estimate, half = partners.estimates(at, code, factor)
            p, m = np.nonzero(estimate + half >= threshold)
            p, m = is_partner[at][p], is_member[m]
            own = home[p] == cell
            # a pair counts once: of two outside the core, from the smaller; of cells that both see, in the smaller
            twice = np.where(own, ~core[m] & (cls[p] >= cls[m]), False)
            probe = m * stride + home[p]
            found = seen_in[np.searchsorted(seen_in, probe).clip(max=max(len(seen_in) - 1, 0))] == probe if len(seen_in) else False
            twice |= ~own & found & (home[p] < cell)
            p, m = p[~twice], m[~twice]
            linked = exact_cosines(rows, rows, p, m) >= threshold
            p, m = p[linked], m[linked]
            links += np.bincount(node[p], weight[m], len(nodes)) + np.bincount(node[m], weight[p], len(nodes))
            forest.join(node[p], node[m])
        some = np.flatnonzero(links)
        return pa.table([pa.array(nodes[some]), pa.array(links[some].astype(np.int64)), pa.array(nodes[forest.root[some]])], schema=schema)

    return run


def _per_cell(counts: dict[int, int], cell: Column) -> Column:
    """Number of parts of a cell of so many rows; cells of one part are not listed."""
    several = {c: -(-n // TILE) for c, n in counts.items() if n > TILE}
    if not several:
        return F.lit(1)
    listed = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])
    return F.coalesce(F.try_element_at(listed, cell), F.lit(1))


def tiles(assigned: DataFrame) -> DataFrame:
    """A row for each tile that a class takes part in, as member (1), partner (2) or both."""
    members = {r[0]: r[1] for r in assigned.groupBy("home").count().collect()}
    partners = assigned.select(
        F.explode(F.concat("visits", F.when(F.col("core"), F.array().cast("array<int>")).otherwise(F.array("home")))).alias("cell"))
    partners = {r[0]: r[1] for r in partners.groupBy("cell").count().collect()}

    def chunks(cell: Column) -> Column:
        return _per_cell(members, cell)

    def rounds(cell: Column) -> Column:
        return _per_cell(partners, cell)

    def spread(parts: Column, salt: int) -> Column:
        return F.pmod(F.xxhash64("class", F.lit(salt)), parts.cast("long")).cast("int")

    def place(cell, chunk, turn, role) -> Column:
        return F.struct(cell.cast("int").alias("cell"), chunk.cast("int").alias("chunk"), turn.cast("int").alias("turn"), role.alias("role"))

    home = F.col("home")
    single = (chunks(home) == 1) & (rounds(home) == 1)
    as_member = F.transform(
        F.sequence(F.lit(0), rounds(home) - 1),
        lambda t: place(home, spread(chunks(home), 1), t, F.when(single & ~F.col("core"), 3).otherwise(1)))

    def as_partner(cell: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), chunks(cell) - 1), lambda c: place(cell, c, spread(rounds(cell), 2), F.lit(2)))

    nowhere = F.array().cast("array<struct<cell:int,chunk:int,turn:int,role:int>>")
    places = F.concat(
        as_member, F.when(single | F.col("core"), nowhere).otherwise(as_partner(home)),
        F.flatten(F.transform("visits", as_partner)))
    return assigned.withColumn("place", F.explode(places)).select("*", "place.*").drop("place")


def class_links(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(class, links to rows of other classes), (class, component) of the classes
    that have a link; ``classes``: class, weight, vec."""
    n, width = classes.agg(F.count("*"), F.max(F.size("vec"))).first()
    most = min(MAX_CELLS, max(1, -(-n // CELL)))
    sample = classes.orderBy(F.xxhash64("vec"), "class").limit(max(SAMPLE, 2 * most)).select("vec").toArrow()
    centre = centres(unit(matrix(sample.column("vec").combine_chunks(), width)), most, threshold)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.select("class", "weight", "vec").schema)
    assigned = written(
        classes.select("class", "weight", "vec").mapInArrow(
            assigner(centre, width, threshold),
            kinds + ", home int, core boolean, visits array<int>, code binary, factor double"),
        "embedding-cells")
    done = written(tiles(assigned).groupBy("cell", "chunk", "turn").applyInArrow(tile(width, threshold), TILE_SQL), "embedding-links")
    core = assigned.where("core").groupBy("home").agg(F.sum("weight").alias("all"), F.min("class").alias("root"))
    in_core = assigned.where("core").select("class", "weight", "home").join(core, "home")
    links = done.select("class", "links").unionByName(
        in_core.select("class", (F.col("all") - F.col("weight")).alias("links"))).groupBy("class").agg(F.sum("links").alias("links"))
    edges = done.select(F.col("class").alias("a"), F.col("root").alias("b")).unionByName(
        in_core.select(F.col("class").alias("a"), F.col("root").alias("b")))
    component = connected_components(edges).select(F.col("node").alias("class"), "component")
    return links, component


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per row of ``table``: id, n_links, component_id, kept."""
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).withColumn("fine", takes_part(F.col("vec")))
    classes = written(
        rows.where("fine").groupBy("vec").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id()),
        "embedding-classes")
    alone = rows.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if not classes.isEmpty():
        links, component = class_links(classes, threshold)
        known = classes.join(links, "class", "left").join(component, "class", "left").withColumn(
            "component", F.coalesce("component", "class"))
        least = known.groupBy("component").agg(F.min("least").alias("component_id"))
        result = known.join(least, "component").select(
            "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
        alone = alone.unionByName(rows.where("fine").join(result, "vec").select("id", "n_links", "component_id"))
    return alone.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS i, vec_id, embedding::DOUBLE[] AS e,
    coalesce(len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
      AND len([x FOR x IN embedding IF x <> 0]) > 0, false) AS fine
  FROM embeddings
), link AS (
  SELECT a.i AS a, b.i AS b FROM v a JOIN v b ON a.i <> b.i AND a.fine AND b.fine
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT i AS a, i AS b FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), least AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.i = b GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least ON least.a = v.i LEFT JOIN degree ON degree.a = v.i
"""
