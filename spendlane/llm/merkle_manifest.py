"""Merkle dataset manifest by nested-struct rollup.

A row's leaf is the hash of its fields.  Per part (language) the leaves are ranked by
id; written with eight as base, a rank is a list of digits.  Blocks of
``8 ** BLOCK_DIGITS`` neighbouring leaves are shuffled together once.  Inside a block
the digit columns are grouped away one after the other, lowest first: each grouping
nests the child structs of a run and hashes them, until a block is one row.  Roots of
blocks are the leaves of the next tier, subroots of parts those of a last tree.  On
the way down each block meets the path of siblings above it by a grouping of the two
rows, not by a join; a transform walks the nested structs, adding each run's siblings
to the path, and an explode emits one proof per leaf.  No row is larger than a block.

Defined results: every row is a leaf, repeated rows and ids too (order: id with null
first, leaf); null fields hash as ``-``; a null part is a part of its own, the first;
an empty table gives an empty manifest.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlane.llm.common import shuffle_partitions, written

BITS = 3  # of a digit: eight nodes make a run
RUN = 1 << BITS
BLOCK_DIGITS = 4  # digits grouped away within a block: 4,096 leaves
LEVELS = 21  # of eight: more leaves than a long counts
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[field(f) for f in fields])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(proof, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""))


def depth_of(n: Column) -> Column:
    """Levels of hashing until ``n`` nodes are one."""
    return sum((F.when(n > F.lit(RUN**j), 1).otherwise(0) for j in range(LEVELS)), F.lit(0)).cast("int")


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with a column ``part``) plus ``at``, the rank in the part from 0, and
    ``depth``.  ``order`` must tell rows apart, so that ranges split any part."""
    spread = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "part", *order)
    ranges = written(
        spread.sortWithinPartitions("part", *order)
        .withColumn("range", F.spark_partition_id())
        .withColumn("number", F.monotonically_increasing_id()),
        "merkle-ranges",
    )
    # a part has one run of numbers in each range it lies in: as many rows as ranges, at most
    runs = ranges.groupBy("part", "range").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    part = Window.partitionBy("part")
    before = F.sum("n").over(part.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = written(
        runs.select(
            "part", "range",
            (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
            depth_of(F.sum("n").over(part)).alias("depth"),
        ),
        "merkle-shifts",
    )
    return ranges.join(shifts, ["part", "range"]).withColumn("at", F.col("number") + F.col("shift")).drop(
        "range", "number", "shift"
    )


def _digit(j: int) -> str:
    return f"digit{j}"


def rolled(nodes: DataFrame) -> DataFrame:
    """One row per block of ``nodes`` (part, depth, at, hash, item): part, depth,
    block, hash, and the nested children."""
    digits = [_digit(j) for j in range(BLOCK_DIGITS)]
    rows = nodes.select(
        "part", "depth", F.shiftright("at", BITS * BLOCK_DIGITS).alias("block"), "hash", F.col("item").alias("below"),
        *[F.shiftright("at", BITS * j).bitwiseAND(F.lit(RUN - 1)).cast("int").alias(d) for j, d in enumerate(digits)],
    ).repartition("part", "block")
    for j, d in enumerate(digits):
        keys = ["part", "depth", "block", *digits[j + 1:]]
        run = F.sort_array(F.collect_list(F.struct(F.col(d).alias("digit"), "hash", "below")))
        joined = F.array_join(F.transform("run", lambda k: k["hash"]), "")
        # above the last level of a part there is one node, which stays as it is
        up = F.when(F.col("depth") > j, digest(joined)).otherwise(F.col("run")[0]["hash"])
        rows = rows.groupBy(*keys).agg(run.alias("run")).select(*keys, up.alias("hash"), F.col("run").alias("below"))
    return rows


def _opened(run: Column, j: int, depth: Column, path: Column) -> Column:
    hashes = F.transform(run, lambda k: k["hash"])

    def child(node: Column, i: Column) -> Column:
        step = F.struct(
            F.array_join(F.slice(hashes, F.lit(1), i), "").alias("before"),
            F.array_join(F.slice(hashes, i + 2, F.lit(RUN)), "").alias("after"),
        )
        longer = F.concat(F.when(depth > j, F.array(step)).otherwise(F.array().cast(PATH)), path)
        if j:
            return _opened(node["below"], j - 1, depth, longer)
        return F.array(F.struct(node["below"].alias("item"), node["hash"].alias("hash"), longer.alias("path")))

    return F.flatten(F.transform(run, child))


def opened(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """part, item, hash, path and ``top`` of every node in ``blocks``, given path and
    top of each block (part, block, path, top)."""
    met = (
        blocks.select("part", "block", "depth", "below")
        .unionByName(above.select("part", "block", "path", "top"), allowMissingColumns=True)
        .groupBy("part", "block")
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("depth", "below", "path", "top")])
    )
    nodes = _opened(F.col("below"), BLOCK_DIGITS - 1, F.col("depth"), F.col("path"))
    return met.select("part", "top", F.explode(nodes).alias("node")).select("part", "top", "node.*")


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of ``nodes``, blocks of their roots, and so on until each part is one
    block; every tier is written."""
    made = [written(rolled(nodes), "merkle-tier")]
    while made[-1].agg(F.max("depth")).first()[0] or 0:
        if made[-1].where(F.col("depth") > BLOCK_DIGITS).isEmpty():
            break
        roots = made[-1].select(
            "part", F.greatest(F.col("depth") - BLOCK_DIGITS, F.lit(0)).alias("depth"), F.col("block").alias("at"),
            "hash", F.col("block").alias("item"),
        )
        made.append(written(rolled(roots), "merkle-tier"))
    return made


def descended(made: list[DataFrame], above: DataFrame) -> DataFrame:
    for blocks in reversed(made):
        nodes = opened(blocks, above)
        above = nodes.withColumnRenamed("item", "block")
    return nodes


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, part: str = "lang", order: str = "doc_id",
             also: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: order column, part column, leaf, subroot, root,
    proof (siblings before and after the own node, level by level up to the root), and
    the columns of ``also``, computed where the rows are read."""
    more = dict(also or {})
    leaves = written(
        docs.select(
            F.coalesce(F.concat(F.lit("1"), F.col(part).cast("string")), F.lit("0")).alias("part"),
            F.col(order).alias("order"),
            leaf_digest([F.col(f) for f in fields]).alias("hash"),
            *[c.alias(f"also_{n}") for n, c in more.items()],
            F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )
    item = F.struct("order", *[f"also_{n}" for n in more])
    nodes = ranked(leaves, ["order", "hash", "row"]).select("part", "depth", "at", "hash", item.alias("item"))
    made = tiers(nodes)
    subroots = made[-1].select("part", "hash")
    # the subroots are the leaves of one more tree, of a single part
    top_nodes = ranked(subroots.select(F.lit("").alias("part"), F.col("part").alias("of"), "hash"), ["of"])
    top_made = tiers(top_nodes.select("part", "depth", "at", "hash", F.col("of").alias("item")))
    root = top_made[-1].select("part", "block", F.array().cast(PATH).alias("path"), F.col("hash").alias("top"))
    above = descended(top_made, root).select(
        F.col("item").alias("part"), F.lit(0).cast("long").alias("block"), "path",
        F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"),
    )
    return descended(made, above).select(
        F.col("item")["order"].alias(order),
        F.when(F.col("part") != "0", F.expr("substring(part, 2)")).alias(part),
        F.col("hash").alias("leaf"), "top.subroot", "top.root", F.col("path").alias("proof"),
        *[F.col("item")[f"also_{n}"].alias(n) for n in more],
    )


ORACLE = """
WITH RECURSIVE bits AS (
  SELECT range::BIGINT AS i, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (SELECT i, c AS t FROM bits WHERE k = 8),
ids AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '') AS d FROM documents),
crc AS (
  SELECT d, 0 AS k, 4294967295::BIGINT AS c FROM ids
  UNION ALL
  SELECT d, k + 1, xor(t, c // 256) FROM crc
  JOIN crc_table ON i = xor(c % 256, ascii(substr(d, k + 1, 1))::BIGINT) WHERE k < len(d)
), hit AS (SELECT d, xor(c, 4294967295) % 3 = 0 AS hit FROM crc WHERE k = len(d)),
shown AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS part, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN hit THEN low ELSE text END, '-')) AS altered
  FROM shown JOIN hit ON d = coalesce(doc_id::VARCHAR, '')
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), tree AS (
  SELECT part, 0 AS level, list(leaf ORDER BY pos) AS hs FROM placed GROUP BY part
  UNION ALL
  SELECT part, level + 1, [sha256(array_to_string(hs[8 * i + 1:8 * i + 8], '')) FOR i IN range((len(hs) + 7) // 8)]
  FROM tree WHERE len(hs) > 1
), subs AS (SELECT part, level AS height, hs[1] AS subroot, row_number() OVER (ORDER BY part) - 1 AS pos FROM tree WHERE len(hs) = 1),
crown AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS hs FROM subs
  UNION ALL
  SELECT level + 1, [sha256(array_to_string(hs[8 * i + 1:8 * i + 8], '')) FOR i IN range((len(hs) + 7) // 8)]
  FROM crown WHERE len(hs) > 1
), top AS (SELECT hs[1] AS root FROM crown WHERE len(hs) = 1),
way AS (
  SELECT part, p.pos, level, p.pos // (8 ** level)::BIGINT AS n, hs FROM placed p JOIN tree USING (part) WHERE len(hs) > 1
  UNION ALL
  SELECT part, p.pos, height + level, s.pos // (8 ** level)::BIGINT, hs
  FROM placed p JOIN subs s USING (part) CROSS JOIN crown WHERE len(hs) > 1
), step AS (
  SELECT part, pos, level, array_to_string(hs[8 * (n // 8) + 1:n], '') AS before,
    array_to_string(hs[n + 2:8 * (n // 8) + 8], '') AS after FROM way
), folding AS (
  SELECT part, pos, 0 AS level, altered AS h FROM placed
  UNION ALL
  SELECT f.part, f.pos, f.level + 1, sha256(before || h || after) FROM folding f
  JOIN step s ON s.part = f.part AND s.pos = f.pos AND s.level = f.level
), folded AS (SELECT part, pos, arg_max(h, level) AS folded_root FROM folding GROUP BY part, pos),
proof AS (SELECT part, pos, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM step GROUP BY part, pos)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN (SELECT part, subroot FROM subs) USING (part) CROSS JOIN top JOIN folded USING (part, pos) LEFT JOIN proof USING (part, pos)
"""
