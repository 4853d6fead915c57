"""Typed storage of the fact table: cast once, read many times.

Text is parsed and typed once and written as Parquet partitioned by pickup
year and month.  Every mart then reads only the columns it needs
(``ReadSchema``), its amount/distance filters reach the Parquet reader
(``PushedFilters``, row-group skipping by min/max), and the weekly mart of
one year reads only that year's partitions (``PartitionFilters``).

The written table is also the lineage cut: marts built on it never go back
to the raw text, so a lost executor costs a re-read of Parquet, not a
re-parse of the input.  Without an explicit path the table goes to a fresh
folder under the session's shared checkpoint folder (``spark.checkpoint.dir``),
never a machine-local folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.session import scratch_path
from farebox.sources import text as TX

YEAR_COL = "pickup_year"
MONTH_COL = "pickup_month"


def with_partition_columns(trips: DataFrame) -> DataFrame:
    pu = F.col(S.PICKUP)
    return trips.withColumn(YEAR_COL, F.year(pu)).withColumn(MONTH_COL, F.month(pu))


def stage_trips(spark: SparkSession, trips: DataFrame, path: str | None = None) -> DataFrame:
    """Write typed trips partitioned by pickup year/month; return the table
    read back.  The rows are rebalanced by month first: adaptive execution
    joins small months and splits a month that holds a third of all trips,
    so the files number with the data, not with splits times months."""
    target = path or scratch_path(spark, "typed-trips")
    (with_partition_columns(trips).hint("rebalance", YEAR_COL, MONTH_COL)
     .write.mode("overwrite").partitionBy(YEAR_COL, MONTH_COL).parquet(target))
    return spark.read.parquet(target)


def stage_text(spark: SparkSession, raw_path: str, path: str | None = None, **options) -> DataFrame:
    """Raw delimited text -> typed, partitioned Parquet (one parse).  Each
    field is typed once here, so numbers follow the text rules (Python's forms) unless the options say otherwise."""
    options.setdefault("text_rules", True)
    return stage_trips(spark, TX.read_trips_text(spark, raw_path, **options), path)
