"""A training corpus from raw documents, in five stages.

Each stage takes the documents that the one before has kept, as a table, and
returns what it keeps; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill.llm import bpe, decontam, neardup, quality, secrets
from loanmill.llm.common import fold, staged, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A document goes if its chance of being good is below this.
LEAST_QUALITY = 0.3


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.train(docs, labels, fold("doc_id", 5) != 0)
    scored = quality.score(docs, model, out="quality_score")
    return scored.filter(F.col("quality_score") >= LEAST_QUALITY).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least id."""
    return neardup.kept_documents(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars counted anew."""
    hidden = secrets.masked(docs, secrets.train(docs))
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document as packed integers, and whether they decode to its
    text."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.round_trip(rows, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "round_trip"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE encoding and decoding", encoded),
]

#: SQL cannot state a learned classifier, MinHash or BPE; tests/llm compares
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, f"stage-{number}")
    return docs
