"""Registered queries of the pipeline operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import (
    audit, bpe, byte_repeats, centroids, chat, decontaminate, exact, lines, minhash, quality, substring, urls, warc)
from farebox.llm.common import load
from farebox.llm.oracles import ORACLES  # noqa: F401


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = load(spark, sf_dir, "documents")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    return bpe.digests(bpe.decode(coded, ranks))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(load(spark, sf_dir, "documents"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_equal", "n_near", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, load(spark, sf_dir, "labels")))


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(load(spark, sf_dir, "pages"), URL_RULES)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    rows = load(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    return chat.read_chats(chat.format_chats(rows.unionByName(extra)))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(
        decontaminate.find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), unnamed=True))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(load(spark, sf_dir, "documents"))


def op11_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_repeats.remove_long_repeats(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digests(centroids.cluster(load(spark, sf_dir, "embeddings")))


QUERIES = {f.__name__: f for f in (
    op1_byte_bpe, op2_warc, op3_exact_dedup, op4_substring, op5_line_dedup, op6_quality, op7_url_filter, op8_chat,
    op9_decontaminate, op10_minhash, op11_suffix_array, op12_filter_audit, op13_centroids)}
