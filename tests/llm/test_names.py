"""Columns whose names are those used inside, or have dots: every operator
and stage takes them, and returns them where it returns its input's columns."""

import os
import sys

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import corpus_pipeline as P  # noqa: E402
from llm_cases import SF, TEXTS, labels  # noqa: E402, F401

from farebox.llm import bpe, decontaminate, exact, lines, minhash, quality, substring  # noqa: E402

NAMES = ["_keep", "_class", "_keep_h", "_keep_g", "_text", "_ids", "_id", "_h", "_g", "_n", "_sha", "_row", "ids", "IDS2", "n_tokens",
         "round_trip", "decoded", "_c", "_kept", "_node", "_set", "_y", "_x", "score", "predicted", "kept", "a.b", "with space", "a`b"]


@pytest.fixture()
def docs(spark):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in TEXTS],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"{k}").alias(n) for k, n in enumerate(NAMES)])


def test_stages_keep_all_columns(spark, docs, labels):
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema == docs.schema or out.columns == docs.columns, name
        for r in out.collect():
            assert [r[n] for n in NAMES] == [f"{k}" for k in range(len(NAMES))], name


def test_last_stage_adds_and_replaces(spark, docs):
    out = P.STAGES[-1][1](spark, docs, SF)
    added = ["n_tokens", "ids", "round_trip"]
    assert out.columns == [c for c in docs.columns if c not in added] + added
    rows = out.collect()
    assert len(rows) == len(TEXTS) and all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] for r in rows)
    assert {r["decoded"] for r in rows} == {str(NAMES.index("decoded"))}


def test_operators_ignore_further_columns(spark, docs, labels):
    bench = spark.createDataFrame([("q", "one two three")], "item_id string, text string").select(
        "*", *[F.lit(1).alias(n) for n in NAMES])
    marks = labels.select("*", *[F.lit(1).alias(n) for n in NAMES])
    plain = docs.select("doc_id", "text")
    model = quality.fit(docs, marks)
    for run in (exact.exact_groups, minhash.near_groups, substring.remove_repeats, lines.drop_repeated_lines,
                lambda d: decontaminate.find_leaks(d, bench), lambda d: quality.score(d, model)):
        got, want = run(docs), run(plain)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tokens_of_any_columns(docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids_col="tokens"), ranks, ids_col="tokens", out_col="bytes of")
    assert out.columns == [*docs.columns, "tokens", "bytes of"]
    assert all(bytes(r["bytes of"]).decode() == (r["text"] or "") for r in out.collect())


def test_pipeline_on_odd_and_empty_tables(spark, docs, tmp_path, labels):
    for k, df in enumerate([docs, docs.limit(0)]):
        base = str(tmp_path / str(k))
        df.withColumn("doc_id", F.coalesce("doc_id", F.lit(None))).write.parquet(f"{base}/documents.parquet")
        labels.write.parquet(f"{base}/labels.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{base}/benchmark.parquet")
        rows = P.run(spark, base).collect()
        assert bool(rows) == (k == 0) and all(r["round_trip"] for r in rows)
        texts = [r["text"] for r in rows]
        assert len({(t or "").translate({c: None for c in (32, 9, 10, 11, 12, 13)}) for t in texts}) == len(texts)
