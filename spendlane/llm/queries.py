"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the result columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlane.llm import (
    chat_format,
    class_lm,
    decontaminate,
    embedding_dedup,
    language_id,
    line_quality,
    merkle_manifest,
    pattern_packing,
    phrase_mining,
    simhash_dedup,
    suffix_dedup,
    token_counts,
    topk_search,
)
from spendlane.llm.common import id_remainder, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    chunks = chat_format.format_conversations(rows, public_tokenizers.path("byte_bpe_50k.json"))
    return chat_format.read_back(chunks).drop("n_tokens")


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pattern_packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=2
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"), folds=5, held=0)
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), min_bytes=50)
    n_bytes = F.octet_length("text").cast("long")
    return done.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length(suffix_dedup.KEPT)).alias("n_removed"),
        F.size(suffix_dedup.SPANS).cast("long").alias("n_spans"),
        F.sha2(F.col(suffix_dedup.KEPT), 256).alias("kept_sha256"),
    )


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, held=1)
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=5, threshold=0.8
    )


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_documents(table(spark, sf_dir, "documents"), folds=5, held=1)


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(50)) == 0, k=5)


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' manifest; texts of every third id lose their capitals afterwards,
    and the proofs must tell."""
    docs = table(spark, sf_dir, "documents").select(*merkle_manifest.FIELDS)
    text = F.when(id_remainder(F.col("doc_id"), 3) == 0, merkle_manifest.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    altered = merkle_manifest.leaf_digest([text if f == "text" else F.col(f) for f in merkle_manifest.FIELDS])
    made = merkle_manifest.manifest(docs, also={"altered": altered})
    return made.select(
        "doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle_manifest.fold(F.col("altered"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"), least=30, covered=80, first=2000)


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_chat_format, op3_pattern_packing, op4_language_id, op5_suffix_dedup,
        op6_line_quality, op7_simhash_dedup, op8_decontamination, op9_class_lm, op10_topk_search,
        op11_embedding_dedup, op12_merkle_manifest, op13_phrase_mining,
    )
}

ORACLES: dict[str, str] = {
    "op2_chat_format": chat_format.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op10_topk_search": topk_search.ORACLE,
    "op11_embedding_dedup": embedding_dedup.ORACLE,
    "op12_merkle_manifest": merkle_manifest.ORACLE,
    "op13_phrase_mining": phrase_mining.ORACLE,
}
