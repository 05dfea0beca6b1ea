"""One query per operator over its whole table, and the SQL that DuckDB can check it with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm import (
    decontam, kneser_ney, lexical, line_dedup, merge_dropout, outliers, rans, shards, simhash, surrogates, toxicity,
    whitening, word_bpe,
)
from tripledger.llm.common import documents
from tripledger.sources.scratch import fresh_path

#: A stand-in; a real run takes its secret from its own store.
SURROGATE_KEY = "surrogate-key"


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeated_chunks(documents(spark, sf_dir).select("doc_id", "text"))
    lines = F.aggregate("spans", F.lit(0), lambda a, s: a + s["last"] - s["first"] + 1)
    return out.select("row.doc_id", "text", lines.cast("long").alias("n_lines_removed"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), shingle=4, distance=4)
    return out.select("row.doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    out = kneser_ney.judge(documents(spark, sf_dir).select("doc_id", "text", "lang"), trusted)
    return out.select("row.doc_id", "lang", F.exp("log_ppl").alias("perplexity"),
                      F.exp("limit").alias("limit"), "kept")


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = surrogates.replace_entities(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY)
    return out.select("row.doc_id", "text", F.col("n_entities").cast("long").alias("n_entities"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = shards.write_shards(docs, fresh_path(spark, "shards"), n_shards=24)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return out.select(
        "row.doc_id", (F.octet_length(text).cast("long") + shards.OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("piece_bpe_32k.model")
    out = merge_dropout.encode(documents(spark, sf_dir).select("doc_id", "text"), path, decoded=True)
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.xxhash64("ids").alias("ids_hash"), F.col("decoded").eqNullSafe(F.col("row.text")).alias("lossless"))


def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = outliers.quality(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "distance")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = decontam.contaminated(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
    return out.select("row.doc_id", "contaminated", F.col("item").alias("item_id"), "n_items")


def op9_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "rans")
    rans.write_tokens(documents(spark, sf_dir).select("doc_id", "text"), path,
                      vocabulary("byte_bpe_50k.json"), end_id=2)
    return rans.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.train(docs, labels, ["low_quality", "toxic"])
    out = toxicity.score(docs, chain)
    return out.select("row.doc_id", "p_low_quality", "p_toxic", F.col("is_toxic").alias("toxic"))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = word_bpe.encode(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), keep=["doc_id"], decoded=True)
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      word_bpe.digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical.search(documents(spark, sf_dir).select("doc_id", "text"), items, k=10)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = whitening.fit(vectors, "embedding", components=16)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    out = whitening.transform(vectors, "embedding", model).select(
        "row.vec_id", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("c", "whitened"))
    explained = F.array(*map(F.lit, model.explained))
    return out.select("vec_id", (F.col("c") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                      "whitened", explained[F.col("c")].alias("explained"),
                      F.lit(model.identity_error).alias("identity_error"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_simhash, op3_kneser_ney, op4_surrogates, op5_sharding, op6_merge_dropout,
    op7_outliers, op8_decontamination, op9_rans, op10_toxicity, op11_word_bpe,
    op12_lexical_search, op13_whitening)}
