"""Dirty raw text made of the benchmark ``lineitem`` table.

Each row's case is fixed arithmetic on its keys, so that the SQL oracle can
state what a tolerant reader must make of every line: header lines, short
records, quoted commas, fields that do not parse, ``nan``, empty, padded and
non-integer zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.plans import storage as ST
from farebox.session import scratch_path
from farebox.sources import lineitem as L
from farebox.sources import text as TX

# Fixed parameters of the derivation (shared with the SQL oracle).
QUOTED_FLAG = '"N,Y"'
LINE_END_FLAG = '"N,\n""Y""\n"'  # a record over three lines, with quotes inside
CASES, CASE_ORDER = 17, 3
(HEADER, SHORT, QUOTED, FARE_TEXT, FARE_NAN, ZONE_EMPTY, ZONE_TEXT, ZONE_DECIMAL, ZONE_PADDED,
 PICKUP_TEXT, PICKUP_EMPTY, TIP_EMPTY, TIP_TEXT, TOTAL_NAN) = range(14)  # the other cases are clean
SHORT_FIELDS = 10
MULTI_LINE_RECORDS = 100_000       # records of a file that cannot be split, some 12 MB
GROUPED, SUFFIXED = 14, 15         # only where number forms are asked for
GROUPED_FARE, SUFFIXED_FARE = "1_2.5", "12.5d"   # a number to Python, and none


def _instead(field: str, cases: dict[int, object]):
    c = TX.text_field(field)
    out = None
    for case, value in cases.items():
        value = F.lit(value) if isinstance(value, str) else value
        hit = F.col("cas") == case
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(c)


def dirty_lines(lineitem: DataFrame, flag: str = QUOTED_FLAG, numbers: bool = False) -> DataFrame:
    """One raw record per row, in the column ``value``; ``flag`` is the quoted
    field of the quoted case, ``numbers`` adds fares in odd number forms."""
    case = (F.col("l_orderkey") * CASE_ORDER + F.col("l_linenumber")) % CASES
    trips = lineitem.select(*L.trip_columns(), case.alias("cas"))
    zone = TX.text_field(S.ZONE)
    spoiled = {
        "store_and_fwd_flag": F.when(F.col("cas") == QUOTED, flag).otherwise("N"),
        "fare_amount": _instead("fare_amount", {
            FARE_TEXT: "abc", FARE_NAN: "nan", **({GROUPED: GROUPED_FARE, SUFFIXED: SUFFIXED_FARE} if numbers else {})}),
        S.ZONE: _instead(S.ZONE, {ZONE_EMPTY: "", ZONE_TEXT: "abc", ZONE_DECIMAL: F.concat(zone, F.lit(".0")),
                                  ZONE_PADDED: F.concat(F.lit(" "), zone, F.lit(" "))}),
        S.PICKUP: _instead(S.PICKUP, {PICKUP_TEXT: "bad", PICKUP_EMPTY: ""}),
        "tip_amount": _instead("tip_amount", {TIP_EMPTY: "", TIP_TEXT: "x"}),
        "total_amount": _instead("total_amount", {TOTAL_NAN: "nan"}),
    }
    names = [n for n, _ in S.TRIP_COLUMNS]
    fields = [spoiled[n] if n in spoiled else TX.text_field(n) if n in trips.columns else F.lit("") for n in names]
    return trips.select(
        F.when(F.col("cas") == HEADER, ",".join(names))
        .when(F.col("cas") == SHORT, F.concat_ws(",", *fields[:SHORT_FIELDS]))
        .otherwise(F.concat_ws(",", *fields)).alias("value"))


def text_files(lines: DataFrame, name: str, records: int | None = None) -> str:
    """Write raw lines as text files below the shared checkpoint folder; ``records``: the most of a file."""
    path = scratch_path(lines.sparkSession, name)
    (lines.write.option("maxRecordsPerFile", records) if records else lines.write).text(path)
    return path


def dirty_files(spark: SparkSession, sf_dir: str, records: int | None = None, **kinds) -> str:
    """The dirty records of the whole ``lineitem`` table as text files; ``records`` as in ``text_files``."""
    lines = dirty_lines(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"), **kinds)
    return text_files(lines, "dirty-trips", records)


def load_dirty_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty lines, read back by the text source."""
    return TX.read_trips_text(spark, dirty_files(spark, sf_dir))


def load_multi_line_trips(spark: SparkSession, sf_dir: str, text_rules: bool = False) -> DataFrame:
    """The dirty records with line ends inside quotes.  A task reads such a file whole, so
    the files number with the records, and no file grows with the table."""
    path = dirty_files(spark, sf_dir, MULTI_LINE_RECORDS, flag=LINE_END_FLAG)
    return TX.read_trips_text(spark, path, multi_line=True, text_rules=text_rules)


def load_staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty lines with odd number forms, typed once into a staged table."""
    return ST.stage_text(spark, dirty_files(spark, sf_dir, numbers=True))
