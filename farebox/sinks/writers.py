"""Mart writers.

By default a write is distributed (one file per partition, globally sorted
when ``order_by`` is given).  Marts are small aggregates whose size is
bounded by their key domain (24 hours, 168 slots, ~265 zones, zones squared
for OD pairs), so the mart catalogue asks for one sorted output file
(``single_file=True``: the reference's one-reducer layout); the single
partition is then applied to the aggregated mart only, after the
distributed aggregation.  Every write replaces its target
(``mode("overwrite")``), so a re-run after a lost executor or a failed job
is idempotent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import schema as S


def _prepare(df: DataFrame, order_by: Sequence[str | Column] | None, single_file: bool) -> DataFrame:
    if single_file:
        # An exchange of finished rows: the final aggregate below it stays
        # parallel, and only the sort of the mart's rows runs in one task.  The order is made
        # in that task, since shuffle blocks arrive in any order; a sort below the exchange falls away.
        df = df.repartition(1)
        return df.sortWithinPartitions(*order_by) if order_by else df
    return df.orderBy(*order_by) if order_by else df


def _fixed(name: str, digits: int) -> Column:
    """Fixed decimals, never an exponent; ``nan`` and ``inf`` as the jobs print
    them; NULL stays NULL."""
    c = F.col(name)
    return (F.when(F.isnan(c), "nan").when(c == float("inf"), "inf").when(c == float("-inf"), "-inf")
            .when(c.isNotNull(), F.format_string(f"%.{digits}f", c)).alias(name))


def mart_text(df: DataFrame, mart: str) -> DataFrame:
    """The mart's DOUBLE columns as text with the decimals the jobs print."""
    digits = S.MART_DECIMALS.get(mart, {})
    return df.select(*[_fixed(n, digits[n]) if n in digits and t == "double" else n for n, t in df.dtypes])


def write_tsv(df: DataFrame, path: str, *, order_by: Sequence[str | Column] | None = None,
              single_file: bool = False, header: bool = False, mart: str | None = None) -> None:
    """Tab-separated, no header (the job output format).  ``mart`` names
    the mart whose number format applies; without it numbers are written as
    Spark prints them."""
    df = _prepare(df, order_by, single_file)   # by the numbers, before they become text
    if mart is not None:
        df = mart_text(df, mart)
    (df.write.mode("overwrite")
     .option("sep", "\t").option("header", header).option("nullValue", "")
     .csv(path))


def write_csv(df: DataFrame, path: str, *, order_by: Sequence[str | Column] | None = None,
              single_file: bool = False) -> None:
    """Comma-separated with a header row (the dashboard's input)."""
    (_prepare(df, order_by, single_file).write.mode("overwrite")
     .option("header", True).csv(path))


def write_json(df: DataFrame, path: str, *, order_by: Sequence[str | Column] | None = None,
               single_file: bool = False) -> None:
    """One JSON record per line (``orient="records"``)."""
    _prepare(df, order_by, single_file).write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """Typed storage for large intermediates (e.g. the typed fact table)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


WRITERS = {"tsv": write_tsv, "csv": write_csv, "json": write_json}
