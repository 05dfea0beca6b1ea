"""The corpus pipeline: each stage reads the documents that its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm import decontam, line_dedup, merge_dropout, outliers, simhash
from tripledger.llm.common import documents, unpacked
from tripledger.llm.queries import vocabulary
from tripledger.sources.scratch import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or lie outside their language and source, go."""
    return unpacked(outliers.quality(docs).where("kept"), docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of multi-line chunks go; `n_chars` follows the text."""
    out = line_dedup.remove_repeated_chunks(docs)
    changed = {"text": F.col("text"), "n_chars": F.when(
        F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return unpacked(out, docs, **{n: c for n, c in changed.items() if n in docs.columns})


def simhash_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id."""
    return unpacked(simhash.near_duplicates(docs, shingle=4, distance=4).where("keeper"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return unpacked(decontam.contaminated(docs, benchmark).where("NOT contaminated"), docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text decoded from them."""
    out = merge_dropout.encode(docs, vocabulary("piece_bpe_32k.model"), decoded=True)
    return unpacked(out, docs, "ids", text=F.col("decoded"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", simhash_deduplication),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: SQL expresses neither the estimates of the first stage nor the fingerprints of the third.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return docs
