"""Reading marts back (S11, S12, S19) and profiling inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox import schema as S


def read_mart_tsv(spark: SparkSession, path: str, mart: str) -> DataFrame:
    """Header-less TSV with the mart's column names and types."""
    return (spark.read.schema(S.MART_SCHEMAS[mart]).option("sep", "\t").option("header", False)
            .options(nanValue="nan", positiveInf="inf", negativeInf="-inf").csv(path))


def read_mart_csv(spark: SparkSession, path: str, mart: str) -> DataFrame:
    """CSV with a header; a missing mart reads as an empty table with
    the mart's schema (the dashboard shows an empty section)."""
    schema = S.MART_SCHEMAS[mart]
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_mart_json(spark: SparkSession, path: str, mart: str) -> DataFrame:
    return spark.read.schema(S.MART_SCHEMAS[mart]).json(path)


def read_back_top(df: DataFrame, by: str, n: int, *, key: Sequence[str] = ()) -> DataFrame:
    """A mart sorted numerically on one column, descending, first
    n; equal values in the order of ``key``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *key).limit(n)


def input_profile(spark: SparkSession, path: str | list[str], *, rows: DataFrame | None = None) -> DataFrame:
    """One row per file below ``path``: ``fichier``, ``octets``.  Sizes come
    from the file listing; no file is opened.  ``rows``, a DataFrame read from
    the same files, adds ``lignes``, its rows per file (0 where a file yields
    none), at the price of reading them.  Spark's listing leaves out files of
    zero bytes and hidden files."""
    at = F.col("_metadata.file_path").alias("fichier")
    files = spark.read.format("binaryFile").load(path).select(at, F.col("_metadata.file_size").alias("octets"))
    if rows is None:
        return files
    counts = rows.select(at).groupBy("fichier").agg(F.count(F.lit(1)).alias("lignes"))
    return files.join(counts, "fichier", "left").fillna(0, ["lignes"])
