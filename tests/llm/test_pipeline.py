import numpy as np
from helpers import brute_dedup, remainder, table_texts  # noqa: F401
from test_decontaminate import brute as contaminated
from test_pattern_packing import check_places
from test_pattern_packing import wanted as pieces
from test_simhash_dedup import wanted as near

import corpus_pipeline


def test_stages_equal_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        seen.append(docs)
        if n < 4:
            assert docs.columns == columns
    texts = [{r.doc_id: r.text for r in d.collect()} for d in seen[:4]]
    before = {r["doc_id"]: r["text"] for r in table_texts(sf_dir)}
    label = {r["doc_id"]: r["quality"] for r in table_texts(sf_dir, "labels")}
    # the classifier keeps nearly all good documents and few bad ones
    assert texts[0].items() <= before.items()
    assert np.mean([i in texts[0] for i, q in label.items() if q == 1]) > 0.97
    assert np.mean([i in texts[0] for i, q in label.items() if q == 0]) < 0.2
    assert texts[1] == {i: texts[0][i] for i, (_, c) in near(list(texts[0].items())).items() if i == c}
    kept = brute_dedup(list(texts[1].items()), 50)
    for i, t in texts[2].items():
        raw = kept[i][0].decode("utf-8", "ignore")  # characters that are cut through stay whole
        assert len(raw) <= len(t) <= len(raw) + 2 * kept[i][1]
    assert texts[2].keys() == texts[1].keys()
    tests = [r["text"] for r in table_texts(sf_dir, "benchmark")]
    order = list(texts[2])
    bad = {order[d] for d, *_ in contaminated([texts[2][i] for i in order], tests)}
    assert texts[3] == {i: t for i, t in texts[2].items() if i not in bad}
    rows = seen[4].collect()
    want = pieces(texts[3].items(), 1024)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    check_places(rows, 1024)


def test_run_gives_the_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def test_every_operator_has_its_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


def test_odd_documents_pass_all_stages(spark, sf_dir, tmp_path):
    """Null ids, repeated rows, null and empty texts: at most one row of each group
    reaches the packing; an empty table gives no piece."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.unionByName(docs.where("doc_id % 2 = 0")).unionByName(
        docs.where("doc_id % 3 = 0").withColumn("doc_id", F.lit(None).cast("long"))).unionByName(
        docs.limit(2).withColumn("text", F.lit(None).cast("string")))
    for name, given in (("odd", odd), ("empty", docs.where("false"))):
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{name}{n}")
            (given if not n else spark.read.parquet(str(tmp_path / f"{name}{n - 1}"))).createOrReplaceTempView("given_docs")
            if name == "empty" and n == 0:
                given.write.parquet(path)  # nothing to judge, nothing to keep
            else:
                stage(spark, spark.table("given_docs"), sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        if name == "empty":
            assert out.count() == 0
        else:
            texts = spark.read.parquet(str(tmp_path / "odd1"))
            assert texts.count() == texts.select(F.coalesce("text", F.lit(""))).distinct().count()
            assert out.count() > 0
