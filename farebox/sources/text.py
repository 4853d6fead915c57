"""Trip records from delimited text (S1-S6) and Parquet.

Text is read with Spark's CSV source over a whole directory (splits are
Spark's own planning) with an explicit schema: fields are typed by the
parser, once, inside the scan.  PERMISSIVE mode nulls only the field that
does not convert; ``mode=DROPMALFORMED`` is deliberately not used, since a
bad fare must not remove the row from the trips-per-hour mart.  The same
parse is available for line-oriented input (``parse_csv_lines``) and, with
explicit text rules, for all-string sources (``type_trips``)."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import schema as S
from farebox.functions import columns as C
from farebox.functions import parsing as P
from farebox.functions import predicates as PR


_FOOTERS = 64      # files whose footers one task reads


def read_raw_trips(spark: SparkSession, path: str | list[str], *,
                   sep: str = ",", header: bool = False,
                   quote: str = '"', escape: str = '"', multi_line: bool = False,
                   corrupt_column: str | None = None) -> DataFrame:
    """All-string 19-column records (for inspection or custom typing).  ``header`` skips the first line of every
    file; blank lines are skipped by the CSV source; short records get NULL
    for the missing fields; quotes are honoured (a doubled quote escapes one).
    Pass ``quote=""`` for the quote-unaware split (S5); ``multi_line`` as in ``read_trips_text``.
    ``corrupt_column`` names a further column with the text of records that have fewer or more than 19 fields."""
    schema = S.RAW_TRIP_SCHEMA
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    reader = (spark.read.schema(schema)
              .option("multiLine", multi_line)
              .option("sep", sep)
              .option("header", header)
              .option("enforceSchema", True)
              .option("mode", "PERMISSIVE")
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    if corrupt_column:
        # all fields are parsed whatever is selected, else the count of fields is not known
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
    if quote == "":
        reader = reader.option("quote", "\u0000")
    else:
        reader = reader.option("quote", quote).option("escape", escape)
    return reader.csv(path)


def typed_text(name: str, dtype: T.DataType) -> Column:
    """A text field under its column's text rule.  The departure zone stays
    text: it is a key of the revenue mart whatever it holds."""
    if name == S.ZONE:
        return P.parse_key(name)
    if isinstance(dtype, T.TimestampNTZType):
        return P.parse_timestamp(name).cast(dtype)
    if isinstance(dtype, T.DoubleType):
        return P.parse_double(name).cast(dtype)
    if isinstance(dtype, T.IntegerType):
        return P.parse_int(name).cast(dtype)
    return F.col(name).cast(dtype)


def type_trips(raw: DataFrame) -> DataFrame:
    """All-string records (``read_raw_trips``, or any string source) -> typed
    trips (``TRIP_SCHEMA``, the departure zone as text) with the explicit text rules of
    ``farebox.functions.parsing``.  Stray header lines (first field
    ``VendorID``) are removed; nothing else is."""
    typed = []
    for name, dtype in S.TRIP_COLUMNS:
        typed.append(typed_text(name, dtype).alias(name))
    return raw.filter(PR.not_header("VendorID")).select(*typed)


# Fixed reader options: the accepted text forms of timestamps and of the
# special float values (as Python writes them).
TIMESTAMP_FORMAT = "yyyy-M-d H:m:s"
CSV_TYPED_OPTIONS = {
    "mode": "PERMISSIVE",
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "nanValue": "nan",
    "positiveInf": "inf",
    "negativeInf": "-inf",
}

# The typed read schema: the fact schema except the first field, kept as
# text so that stray header lines can be recognised and removed, and the
# zones: the departure zone is a text key, the other one a padded INT.
TYPED_READ_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType() if n in ("VendorID", S.ZONE, "DOLocationID") else t, True) for n, t in S.TRIP_COLUMNS])
TYPED_READ_DDL = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}"
                           for f in TYPED_READ_SCHEMA.fields)


def finish_typed(df: DataFrame) -> DataFrame:
    """Drop stray header lines, type the first field, trim the zone key."""
    return (df.filter(PR.not_header("VendorID"))
            .withColumns({"VendorID": P.parse_int("VendorID"), S.ZONE: P.parse_key(S.ZONE),
                          "DOLocationID": C.zone_number("DOLocationID")}))


def read_trips_text(spark: SparkSession, path: str | list[str], *, sep: str = ",",
                    header: bool = False, quote: str = '"', escape: str = '"',
                    text_rules: bool = False, multi_line: bool = False) -> DataFrame:
    """Typed trips from a directory (or list) of delimited text files.

    Spark's CSV reader types every field while it parses the line (once per
    field, inside the scan, with the marts' filters pushed into the reader).
    In PERMISSIVE mode a field that does not convert becomes NULL and the
    rest of the record is kept, so a bad fare only removes the trip from the
    marts that read the fare.  Header lines are dropped
    wherever they stand, known by their first field; ``header=True`` skips the first line of every
    file whatever it holds.  Blank lines are skipped; short records get NULL for the missing fields.
    ``quote=""`` gives the quote-unaware split (S5).

    ``text_rules=True`` reads every field as text and types it with the
    explicit rules of ``farebox.functions.parsing`` instead (digit-group
    underscores accepted, Java-style ``1.5d`` rejected, as Python's float
    does); slower, because those rules are evaluated where each field is
    used.  Stage the result (``plans.storage``) before computing marts.

    ``multi_line=True`` reads records whose quoted fields hold line ends.  Where a
    record ends then depends on all quotes before it, so a file cannot be split: it is the unit of
    work, and a task reads it whole, as a stream.  Keep such files to a few hundred MB, and many."""
    if text_rules:
        return type_trips(read_raw_trips(spark, path, sep=sep, header=header,
                                         quote=quote, escape=escape, multi_line=multi_line))
    reader = (spark.read.schema(TYPED_READ_SCHEMA).options(**CSV_TYPED_OPTIONS)
              .option("multiLine", multi_line).option("sep", sep).option("header", header).option("enforceSchema", True))
    if quote == "":
        reader = reader.option("quote", "\u0000")
    else:
        reader = reader.option("quote", quote).option("escape", escape)
    return finish_typed(reader.csv(path))


def conform_trips(df: DataFrame) -> DataFrame:
    """Cast whatever trip columns a source has, in any letter case, to the
    fact schema types.  Text fields follow the text rules; zoned timestamps
    become naive wall-clock time in the session time zone.  Of columns that
    differ in case only, the exact name counts, else the first."""
    here: dict[str, str] = {}
    for n in df.columns:
        here.setdefault(n.lower(), n)
    here.update({n.lower(): n for n, _ in S.TRIP_COLUMNS if n in df.columns})
    cols = []
    for name, dtype in S.TRIP_COLUMNS:
        if name.lower() not in here:
            continue
        src = df.schema[here[name.lower()]].dataType
        if isinstance(src, T.StringType):
            cols.append(typed_text(name, dtype).alias(name))
        else:
            cols.append(F.col(name).cast(dtype).alias(name) if src != dtype else F.col(name).alias(name))
    return df.select(*cols)


def _footer_types(batches):
    """In tasks: for each file its footer's columns and types as text; NULL
    where the file system is one that only Spark reads."""
    import pyarrow as pa
    import pyarrow.fs
    import pyarrow.parquet as pq

    for batch in batches:
        types = []
        for path in batch.column("path").to_pylist():
            try:
                fs, name = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with fs.open_input_file(name) as f:
                    types.append("; ".join(f"{x.name} {x.type}" for x in pq.read_schema(f)))
            except (OSError, ValueError, pa.ArrowNotImplementedError):
                types.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(types, pa.string())], ["path", "types"])


def same_schema_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files below ``paths`` by schema.  Tasks read the footers; the
    driver gets a file's path and types, no more than its listing holds, and itself
    reads a footer only where a task could not."""
    files = spark.read.format("binaryFile").load(paths).select("path")
    n = max(1, len(files.inputFiles()) // _FOOTERS)
    groups: dict[str, list[str]] = {}
    for r in files.repartition(n).mapInArrow(_footer_types, "path string, types string").collect():
        types = r["types"] if r["types"] is not None else spark.read.parquet(r["path"]).schema.simpleString()
        groups.setdefault(types, []).append(r["path"])
    return list(groups.values())


def read_trips_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed trips from Parquet.  Column pruning and predicate pushdown
    reach the scan because the marts only select and filter plain columns.

    The footers are merged by Spark in parallel, so a column that only some
    files have is kept.  Files whose types differ (a count written as DOUBLE
    one month, as BIGINT the next) are read group by group, each conformed to
    the fact schema, and united; only then are the schemas looked at file by file, in tasks.  A
    zone that is text in one group is text in all."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        return conform_trips(spark.read.option("mergeSchema", True).parquet(*paths))
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    parts = [conform_trips(spark.read.parquet(*g))
             for g in same_schema_groups(spark, paths)]
    if len({str(p.schema[S.ZONE].dataType) for p in parts if S.ZONE in p.columns}) > 1:
        parts = [p.withColumn(S.ZONE, F.col(S.ZONE).cast("string")) if S.ZONE in p.columns else p for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def parse_csv_lines(lines: DataFrame, column: str = "value", *, sep: str = ",") -> DataFrame:
    """S4 for line-oriented input (``spark.read.text``, a message value, a
    string column): the same quote-aware, typing parse as the file reader,
    applied to each line.  Blank lines are dropped."""
    opts = {**CSV_TYPED_OPTIONS, "sep": sep, "quote": '"', "escape": '"'}
    # The parse is the generator of a Generate node (one row per non-blank
    # line, none for a blank one): the parsed fields are columns, so no
    # predicate carries a copy of the parser or of the expression that
    # produced the line.
    line = F.col(column)
    one_record = F.when(F.length(line) > 0, F.array(F.from_csv(line, TYPED_READ_DDL, opts)))
    return finish_typed(lines.select(F.inline(one_record)))


def text_field(name: str):
    c = F.col(name)
    # A naive timestamp casts to 'yyyy-MM-dd HH:mm:ss' text without any time
    # zone (date_format would go through the session zone).
    return F.coalesce(c.cast("string"), F.lit(""))


def trips_as_text(trips: DataFrame, *, sep: str = ",") -> DataFrame:
    """Encode typed trips as raw delimited lines (one ``value`` column), the
    layout of the source files: 19 positional fields, empty when unknown.
    Doubles are written in their shortest exact form, so a text round trip
    returns the same values."""
    fields = []
    for name, _ in S.TRIP_COLUMNS:
        fields.append(text_field(name) if name in trips.columns else F.lit(""))
    return trips.select(F.concat_ws(sep, *fields).alias("value"))
