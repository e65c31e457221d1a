import hashlib
import zlib

import pytest

from helpers import DOCS, clashing, documents
from oracle_compare import compare
from pyspark.sql import functions as F
from spendlane.llm import merkle_manifest as M
from spendlane.llm.queries import ORACLES, op12_merkle_manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*[row[f] for f in M.FIELDS[:-1]], text)])


def climb(nodes):
    """root and, for each node, its siblings (before, after) level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, n in enumerate(at):
            lo = n // 8 * 8
            ways[i].append(("".join(nodes[lo:n]), "".join(nodes[n + 1:lo + 8])))
        nodes, at = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], [n // 8 for n in at]
    return nodes[0], ways


def brute(rows):
    parts = {}
    for r in rows:
        parts.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    subs = {p: climb([x[2] for x in sorted(parts[p], key=lambda x: x[:3])]) for p in order}
    root, tops = climb([subs[p][0] for p in order])
    out = []
    for p, top in zip(order, tops, strict=True):
        for (_, _, digest, r), way in zip(sorted(parts[p], key=lambda x: x[:3]), subs[p][1], strict=True):
            text, d = r["text"], "" if r["doc_id"] is None else str(r["doc_id"])
            if text is not None and zlib.crc32(d.encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = leaf(r, text)
            for before, after in way + top:
                h = H(before, h, after)
            out.append((r["doc_id"], digest, subs[p][0], root, H(*[b + a for b, a in way + top]), h, h == root))
    return out


class Given:
    def __init__(self, df, path):
        df.write.parquet(f"{path}/documents.parquet")
        self.path = str(path)


def run(spark, df, path):
    got = op12_merkle_manifest(spark, Given(df, path).path)
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)


@pytest.mark.parametrize("digits", (1, 2, 4))
def test_equals_brute_force(spark, tmp_path, monkeypatch, digits):
    monkeypatch.setattr(M, "BLOCK_DIGITS", digits)
    langs = [("de", "fr", None, "", "É", "one")[min(5, (i * i) % 7)] if i else "lone" for i in range(700)]
    texts = [None if i % 41 == 0 else f"Text ÀÉ {i % 300} " * (i % 4) for i in range(700)]
    df = documents(spark, texts, [i * 37 % 1000 - 100 for i in range(700)], langs)
    assert run(spark, clashing(df), tmp_path) == sorted(brute([r.asDict() for r in df.collect()]), key=repr)


def test_odd_rows(spark, tmp_path):
    """Null and repeated ids, repeated rows, null fields, a very long text, many languages."""
    rows = [(None, "A", "de", "s", 1), (None, "B", "de", None, None), (5, "Same", "de", "s", 4), (5, "Same", "de", "s", 4),
            (5, "other", "de", "s", 4), (-1, "", None, "", 0), (9, "LONG word " * 200000, None, "s", None)]
    rows += [(100 + i, "x" * i, f"l{i:02d}", "s", i) for i in range(70)]
    df = spark.createDataFrame(rows, DOCS)
    assert run(spark, df, tmp_path) == sorted(brute([r.asDict() for r in df.collect()]), key=repr)


def test_empty_table_and_single_row(spark, tmp_path):
    assert run(spark, spark.createDataFrame([], DOCS), tmp_path / "a") == []
    df = documents(spark, ["One"], [7], [None])
    (row,) = run(spark, df, tmp_path / "b")
    assert row[1] == row[2] == row[3] and row[4] == H()


def test_general_interface(spark):
    """Other columns as fields and parts; proofs as siblings that fold to the root."""
    df = spark.createDataFrame([(i, f"k{i % 3}", i * 1.5) for i in range(50)], "n long, k string, v double")
    made = M.manifest(df, fields=("k", "v"), part="k", order="n").collect()
    assert len(made) == 50 and len({r.root for r in made}) == 1 and len({r.subroot for r in made}) == 3
    folded = M.manifest(df, fields=("k", "v"), part="k", order="n").select(
        (M.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok")).distinct().collect()
    assert [r.ok for r in folded] == [True]


def test_no_join_below_the_proofs(spark, tmp_path):
    df = documents(spark, ["a", "B"] * 20)
    plan = op12_merkle_manifest(spark, Given(df, tmp_path).path)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark, sf_dir):
    r = compare(op12_merkle_manifest(spark, sf_dir), ORACLES["op12_merkle_manifest"], sf_dir)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"], r
