"""Exact top-k search by block-at-a-time pruning.

Vectors become integers, floor(``scale`` * x).  Rows are numbered once, dealt to groups
of bounded size, and within a group ordered by the nearest of a few of its own rows, so
that a block holds rows that point alike.  A block keeps, for each dimension (term), the
largest and the smallest component and its forward index: the rows' components.  The
sum over terms of the larger of q * max and q * min bounds every score in the block.

Queries come in blocks too and meet every group of candidate blocks once.  For each
query the blocks of a group are taken in the order of their bounds and scored
through their forward indexes, until no bound reaches the query's kth score so far.
Every group gives at most k rows for a query; a window that keeps k merges them.

Vectors that are null, hold a null or non-finite component, or have a null id take
no part.  Shorter vectors count as zero beyond their end.  Every row is a candidate for
every query but itself, and a query if its id is one: rows that share an id, or repeat
each other altogether, count one by one.  Ties go to the smaller id.  Empty tables give
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlane.llm.common import written

BLOCK = 128  # candidates of a block
GROUP = 8192  # candidates of a group: what a task holds at once
QUERY_BLOCK = 512
ROUND = 64  # query blocks that a task holds at once
SAFE = 2.0**53


def integer_vectors(table: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id, v (array of longs) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fine = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return table.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v")
    )


def matrix(vectors: list) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def products(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer q @ rows.T: in doubles where every sum stays below 2**53."""
    if not q.size or not rows.size:
        return np.zeros((len(q), len(rows)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(rows).max()) * q.shape[1] < SAFE:
        return (q.astype(float) @ rows.astype(float).T).astype(np.int64)
    exact = q.astype(object) @ rows.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def block_bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """(queries, blocks) upper bounds of the scores."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    if q.size and high.size and float(np.abs(q).max()) * float(max(np.abs(high).max(), np.abs(low).max())) * q.shape[1] >= SAFE:
        return np.full((len(q), len(high)), np.iinfo(np.int64).max)
    return products(up, high) + products(down, low)


def layout(rows: np.ndarray) -> np.ndarray:
    """The rows in the order of their blocks: those nearest to the same of a few
    evenly spread rows follow one another."""
    n = len(rows)
    some = rows[np.linspace(0, n - 1, min(n, max(1, n // BLOCK))).astype(int)].astype(float)
    length = np.linalg.norm(some, axis=1)
    some = some[length > 0] / length[length > 0][:, None]
    if not len(some):
        return np.arange(n)
    return np.argsort((rows.astype(float) @ some.T).argmax(axis=1), kind="stable")


def search_group(q_rows: np.ndarray, q: np.ndarray, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """The k best rows of a group for every query: (query index, id, score).  ``q_rows``
    and ``numbers`` are the row numbers of queries and candidates."""
    width = max(q.shape[1], rows.shape[1])
    q, rows = widened(q, width), widened(rows, width)
    order = np.lexsort((numbers, ids))  # a place in this order decides ties
    ids, rows, numbers = ids[order], rows[order], numbers[order]
    place = layout(rows)
    rows, numbers = rows[place], numbers[place]
    at = np.arange(0, len(ids), BLOCK)
    bounds = block_bounds(q, np.maximum.reduceat(rows, at), np.minimum.reduceat(rows, at))
    best_first = np.argsort(-bounds, axis=1, kind="stable")
    scores = np.full((len(q), k), np.iinfo(np.int64).min)
    found = np.full((len(q), k), -1, np.int64)  # places; -1: none yet
    live = np.arange(len(q))
    for turn in range(len(at)):
        block = best_first[live, turn]
        # the kth so far; a block whose bound only equals it may still win a tie by id
        going = (bounds[live, block] >= scores[live, -1]) | (found[live, -1] < 0)
        live, block = live[going], block[going]
        if not len(live):
            break
        for b in np.unique(block).tolist():
            mine = live[block == b]
            lo, hi = int(at[b]), min(int(at[b]) + BLOCK, len(ids))
            new = products(q[mine], rows[lo:hi])
            number = np.broadcast_to(place[lo:hi], new.shape)
            number = np.where(numbers[lo:hi][None, :] == q_rows[mine][:, None], -1, number)
            s, f = np.concatenate((scores[mine], new), 1), np.concatenate((found[mine], number), 1)
            absent = f < 0
            top = np.lexsort((f, -np.maximum(s, np.iinfo(np.int64).min + 1), absent), axis=1)[:, :k]
            scores[mine], found[mine] = np.take_along_axis(s, top, 1), np.take_along_axis(f, top, 1)
    here = found >= 0
    return np.nonzero(here)[0], ids[found[here]], scores[here]


def top_k(table: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row of ``table`` that
    ``is_query`` (a function of the id column) picks."""
    # numbered once, so that a retried task cannot number rows anew
    vectors = written(integer_vectors(table, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    queries = vectors.where(is_query(F.col("id")))
    n, n_queries = vectors.count(), queries.count()
    groups, n_blocks = max(1, -(-n // GROUP)), max(1, -(-n_queries // QUERY_BLOCK))
    rounds = -(-n_blocks // ROUND)
    # dealt by row, so a crowded id spreads too
    grp = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    blocks = vectors.withColumn("grp", grp).withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    qblock = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks)).cast("int")
    # the stated queries against all groups, in blocks: a block goes to each group once
    dealt = (
        queries.withColumn("qblock", qblock)
        .groupBy("qblock").agg(F.collect_list(F.struct("id", "row", "v")).alias("q"))
        .withColumn("round", F.floor(F.col("qblock") / F.lit(ROUND)).cast("int"))
        .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    )
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, numbers, rows = left.column("id").to_numpy(), left.column("row").to_numpy(), matrix(left.column("v").to_pylist())
        out = [[], [], [], []]
        for q in right.column("q").to_pylist():
            q_ids = np.array([x["id"] for x in q], np.int64)
            q_rows = np.array([x["row"] for x in q], np.int64)
            who, vec, score = search_group(q_rows, matrix([x["v"] for x in q]), numbers, ids, rows, k)
            for column, values in zip(out, (q_rows[who], q_ids[who], vec, score), strict=True):
                column.append(values)
        return pa.table([pa.array(np.concatenate(c)) for c in out], schema=schema)

    hits = blocks.groupBy("grp", "round").cogroup(dealt.groupBy("grp", "round")).applyInArrow(
        run, "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS i, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS (
  SELECT q.i, q.vec_id AS query_id, c.vec_id,
    list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON c.i <> q.i WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
