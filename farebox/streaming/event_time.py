"""Counts per hour of event time, with late rows and closed state.

The marts of ``streaming.incremental`` keep all their groups for ever, which a fixed
key domain allows.  Hours of event time have no end, so here a watermark
closes them: an hour is final once the watermark, the latest event time seen
less ``delay``, has passed its end.  It is then appended to the output and leaves the state store.
A row whose hour is already closed is dropped and counted.

The output is a file sink: each closed hour is written once, also
after a failure, and a reader of the folder sees committed batches only.

Spark's watermark needs zoned timestamps; the naive event times of the sources become the instant that reads the same in
UTC, and the hours become naive again, so no session time zone moves them."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farebox.functions import columns as C

DELAY, WIDTH = "2 hours", "1 hour"
DROPPED, HELD = "numRowsDroppedByWatermark", "numRowsTotal"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_PARTITIONS = "spark.sql.shuffle.partitions"

WINDOW_SCHEMA = T.StructType([
    T.StructField("debut", T.TimestampNTZType()), T.StructField("fin", T.TimestampNTZType()),
    T.StructField("nb_evenements", T.LongType()), T.StructField("valeur_totale", T.DoubleType())])


def instant(c: Column) -> Column:
    """A naive timestamp as the instant that reads the same in UTC (by the
    difference of naive timestamps, which knows no zone)."""
    seconds = (c - F.expr(_EPOCH)).cast("interval second").cast("decimal(18,6)")
    return F.timestamp_micros((seconds * F.lit(1_000_000)).cast("long"))


def wall_clock(c: Column) -> Column:
    """The instant's reading in UTC, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH))


def event_windows(events: DataFrame, *, time_col: str = "ts", value_col: str = "value", width: str = WIDTH,
                  delay: str = DELAY) -> DataFrame:
    """Rows and total value per window of event time: ``debut``, ``fin``,
    ``nb_evenements``, ``valeur_totale``.  Over a stream the watermark closes
    the windows; over a table all windows are there.  A row without an event time is in none."""
    timed = events.withColumn("_at", instant(F.col(time_col)))
    if events.isStreaming:
        timed = timed.withWatermark("_at", delay)
    counted = timed.groupBy(F.window("_at", width).alias("_w")).agg(
        F.count(F.lit(1)).alias("nb_evenements"), C.round_half_up(F.sum(value_col), 2).alias("valeur_totale"))
    return counted.select(wall_clock(F.col("_w.start")).alias("debut"), wall_clock(F.col("_w.end")).alias("fin"),
                          "nb_evenements", "valeur_totale")


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    """Shuffle partitions, and so state stores, of a query that starts inside."""
    old = spark.conf.get(_PARTITIONS)
    if n is not None:
        spark.conf.set(_PARTITIONS, n)
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, old)


def start_windows(events: DataFrame, output: str, *, checkpoint: str | None = None, available_now: bool = True,
                  processing_time: str | None = None, state_partitions: int | None = None, **params) -> StreamingQuery:
    """Append the closed windows of a stream to the Parquet folder ``output``.
    ``available_now`` takes what has arrived and ends, as a scheduled job
    does; the state goes on from ``checkpoint`` with the next start.
    ``state_partitions`` counts at the first start only, the checkpoint keeps it."""
    w = (event_windows(events, **params).writeStream.outputMode("append").format("parquet")
         .option("path", output).option("checkpointLocation", checkpoint or f"{output.rstrip('/')}-checkpoint"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    with _state_partitions(events.sparkSession, state_partitions):
        return w.start()


def read_windows(spark: SparkSession, output: str) -> DataFrame:
    """The closed windows written so far."""
    return spark.read.schema(WINDOW_SCHEMA).parquet(output)


def state_rows(query: StreamingQuery) -> tuple[int, int]:
    """Of the query's batches: groups dropped as late (a task's rows of one
    window are one group), and windows still held."""
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    return sum(s[DROPPED] for s in states), states[-1][HELD] if states else 0


def account(events: DataFrame, windows: DataFrame, *, time_col: str = "ts", width: str = WIDTH, delay: str = DELAY) -> DataFrame:
    """What became of the rows that arrived: ``recus``, ``sans_heure`` (no
    event time), ``comptes`` (in closed windows), ``ouverts`` (in windows
    still open), ``tardifs`` (dropped as late).  The rows are summed up by window, map-side; a
    window is open if it ends after the last watermark, which Spark keeps in milliseconds."""
    at = instant(F.col(time_col))
    # the window's end by arithmetic, since ``window`` leaves out rows without a time
    size = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {width}"))
    end = F.timestamp_micros(((F.floor(F.unix_micros(at) / size) + 1) * size).cast("long"))
    arrived = events.select(end.alias("fin"), at.alias("at")).groupBy("fin").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.date_trunc("MILLISECOND", "at")).alias("at"))
    mark = arrived.agg(F.max("at") - F.expr(f"INTERVAL {delay}")).scalar()
    closed = windows.agg(F.coalesce(F.sum("nb_evenements"), F.lit(0))).scalar()
    n, zero = F.col("n"), F.lit(0)
    seen = arrived.agg(F.coalesce(F.sum(n), zero).alias("recus"),
                       F.coalesce(F.sum(F.when(F.col("fin").isNull(), n)), zero).alias("sans_heure"),
                       F.coalesce(F.sum(F.when(F.col("fin") > mark, n)), zero).alias("ouverts"))
    return seen.select("recus", "sans_heure", closed.alias("comptes"), "ouverts",
                       (F.col("recus") - F.col("sans_heure") - closed - F.col("ouverts")).alias("tardifs"))
