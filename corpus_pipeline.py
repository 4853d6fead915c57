"""Corpus pipeline: quality, exact copies, near copies, benchmark passages,
token ids.  Each stage takes (spark, docs, sf_dir) and returns a DataFrame;
``run`` writes it as Parquet below the shared checkpoint folder and reads it
again as the next stage's ``docs``.  All stages but the last keep the
columns of ``documents``; the last adds ``n_tokens``, ``ids`` and drops nothing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import bpe, decontaminate, exact, minhash, quality
from farebox.llm.common import load, quoted, unused, write_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.drop_rejects(docs, quality.fit(docs, load(spark, sf_dir, "labels")))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact copies."""
    return exact.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its token ids, which decode to its text; columns
    of the names that this adds are replaced."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    text = unused(coded.columns, "decoded")
    decoded = bpe.decode(coded, ranks, out_col=text)
    rest = [c for c in docs.columns if c.lower() not in ("n_tokens", "ids", "round_trip")]
    return decoded.select(
        *map(quoted, rest), F.size("ids").cast("long").alias("n_tokens"), "ids",
        (quoted(text) == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("quality", keep_good), ("exact", drop_exact), ("near", drop_near),
          ("decontaminate", drop_leaks), ("bpe", tokenise)]

# No SQL: the classifier and the rank merges cannot be expressed; the tests
# hold run() against the brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
