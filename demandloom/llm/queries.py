"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import binary_tokens, decontaminate, embedding_join, manifest, maxent_lm, ngram_join, quality_crf, sampled_pieces, secrets, sql, substring_dedup, token_counts, url_rules, whitening
from demandloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, text: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if text is not None:
            SQL[name] = text
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_ngram_jaccard_join", sql.NGRAM_JOIN)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(docs, ngram_join.Similarity(4, 85, 100)).drop("class_id")


@query("op3_embedding_near_dedup", sql.EMBEDDINGS)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_join.near_embeddings(table(spark, folder, "embeddings"), 0.98)


@query("op6_token_id_binary_output")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = scratch_path(spark, "token-files")
    binary_tokens.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return binary_tokens.read(spark, path, keep_ids=False).drop("ids")


@query("op4_quality_classifier")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = quality_crf.remainder("doc_id", 4) == 2
    model = quality_crf.fit(docs, table(spark, folder, "labels"), held_out)
    return quality_crf.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality_crf.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_secret_scans")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.where(F.col("probability") >= secrets.CUT).select(
        "doc_id", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "probability")


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("score", F.round("score", 6))


@query("op9_sentencepiece_sampling")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sampled_pieces.encode_samples(table(spark, folder, "documents"), model, k=2)
    return sampled_pieces.decode(encoded, model).select(
        "doc_id", "sample", "n_pieces", F.round("log_prob", 6).alias("log_prob"), F.round("inclusion", 9).alias("inclusion"), "ids_crc32",
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


@query("op8_lm_scoring")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(quality_crf.remainder("doc_id", 10) == 0, F.lit(False))
    return maxent_lm.lm_scores(docs.withColumn("held_out", held_out))


@query("op10_substring_dedup", sql.SUBSTRINGS)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, folder, "documents"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return whitening.whiten(rows, whitening.fit_whitening(rows, components=16))


@query("op12_merkle_manifest", sql.MANIFEST)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest(table(spark, folder, "documents"))


@query("op13_url_filters", sql.URL_FILTERS)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, folder, "pages").select("page_id", "url"))
