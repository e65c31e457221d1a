"""Corpus pipeline: five operators, each working on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again.  All but the last return the columns of documents.

1. quality classifier: documents that it rejects go
2. SimHash near-dedup: one document of each group stays
3. suffix-array dedup: repeated passages are cut out of the later documents; a
   document of which nothing is left stays, with an empty text
4. benchmark decontamination: documents that hold a test item go
5. best-fit packing: the pieces of all documents, placed in sequences
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spendlane.llm import decontaminate, line_quality, pattern_packing, simhash_dedup, suffix_dedup
from spendlane.llm.common import table
from spendlane.shared import clean_up, mark, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.accepted(docs, line_quality.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.one_of_each(docs, words=4, max_bits=4)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, min_bytes=50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), words=5, threshold=0.8)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = pattern_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

ORACLE_SQL = None  # learned decisions and fingerprints; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path, before = f"{root}/{number}", mark(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        clean_up(spark, since=before)  # what the stage wrote on its way
        docs = spark.read.parquet(path)
    return docs
