"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill.llm import (
    anchors,
    bpe,
    codes,
    decontam,
    katz,
    langid,
    manifest,
    neardup,
    quality,
    secrets,
    suffix,
    tokenfiles,
    topk,
)
from loanmill.llm.common import fold, table
from loanmill.llm.oracles import ORACLES


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.passages(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    model = quality.train(
        documents, table(spark, sf_dir, "labels", "doc_id", "quality"), fold("doc_id", 5) != 0
    )
    return quality.score(documents, model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(
        _documents(spark, sf_dir), neardup.Likeness(words=3, percent=85)
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return secrets.digests(documents, secrets.train(documents))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_documents(spark, sf_dir), fold("doc_id", 7) != 2)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.digests(_documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.train(documents, fold("doc_id", 5) != 0)
    return langid.identify(documents.drop("lang"), model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "lang_spans"
    )


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(_documents(spark, sf_dir))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digests(table(spark, sf_dir, "documents", *manifest.FIELDS))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfiles.digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digests(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_bpe": op2_bpe,
    "op3_topk": op3_topk,
    "op4_quality": op4_quality,
    "op5_near_dedup": op5_near_dedup,
    "op6_secrets": op6_secrets,
    "op7_katz": op7_katz,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language": op9_language,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_manifest": op11_manifest,
    "op12_token_files": op12_token_files,
    "op13_vector_codes": op13_vector_codes,
}

__all__ = ["ORACLES", "QUERIES"]
