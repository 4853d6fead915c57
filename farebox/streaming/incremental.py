"""Marts kept up to date while trip files land in a directory.

The batch jobs rescan the whole input directory on every run.  Here the same
directory is a Structured Streaming file source: each trigger reads only the
files that arrived since the last one, and the marts' aggregation state (a
few hundred keys per mart) lives in the state store under a checkpoint in
the shared checkpoint folder, so a restarted query resumes where it stopped.

The mart definitions are the batch ones (``farebox.operators.marts``) with
``sort=False``: aggregates are emitted in ``complete`` mode, i.e. each
trigger produces the whole, current mart, which ``foreachBatch`` writes
(replacing the previous version) or a memory sink exposes for tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from farebox import schema as S
from farebox.operators import marts as A
from farebox.session import scratch_path
from farebox.sinks import writers as W
from farebox.sources import text as TX

STREAMABLE: dict[str, Callable[..., DataFrame]] = {
    "trips_per_hour": lambda t, **k: A.trips_per_hour(t, sort=False),
    "revenue_per_zone": lambda t, rounding="sql", **k: A.revenue_per_zone(t, sort=False, rounding=rounding),
    "speed_analysis": lambda t, rounding="sql", **k: A.speed_analysis(t, sort=False, rounding=rounding),
    "peak_revenue": lambda t, rounding="sql", **k: A.peak_revenue(t, sort=False, rounding=rounding),
    "payment_methods": lambda t, **k: A.payment_methods(t, sort=False),
    "od_flows": lambda t, **k: A.od_flows(t, top=None, sort=False),
    "weekly_revenue": lambda t, year=S.WEEKLY_YEAR, **k: A.weekly_revenue(t, year=year, sort=False),
    "suspicious_trips": lambda t, **k: A.suspicious_trips(t),
    "peak_vs_offpeak": lambda t, **k: A.peak_vs_offpeak(t, sort=False),
    "total_trips": lambda t, **k: A.total_trips(t),
}


def trip_stream(spark: SparkSession, path: str, fmt: str = "csv", *,
                max_files_per_trigger: int | None = None, **csv_options) -> DataFrame:
    """Typed trips from files arriving in ``path`` (CSV text or Parquet); the
    CSV options are those of ``read_trips_text``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        by_rules = csv_options.get("text_rules", False)
        quote = csv_options.get("quote", '"')
        lines = (reader.schema(S.RAW_TRIP_SCHEMA if by_rules else TX.TYPED_READ_SCHEMA)
                 .options(**TX.CSV_TYPED_OPTIONS)
                 .option("header", csv_options.get("header", False))
                 .option("multiLine", csv_options.get("multi_line", False))
                 .option("sep", csv_options.get("sep", ","))
                 .option("quote", quote or "\u0000")
                 .option("escape", csv_options.get("escape", '"')).csv(path))
        return TX.type_trips(lines) if by_rules else TX.finish_typed(lines)
    if fmt == "parquet":
        return TX.conform_trips(reader.schema(S.TRIP_SCHEMA).parquet(path))
    raise ValueError(f"unsupported stream format: {fmt!r}")


def mart_stream(trips: DataFrame, name: str, **params) -> DataFrame:
    if name not in STREAMABLE:
        raise ValueError(f"mart {name!r} cannot be maintained incrementally")
    return STREAMABLE[name](trips, **params)


def start_mart(spark: SparkSession, trips: DataFrame, name: str, *,
               output: str | None = None, fmt: str = "csv",
               checkpoint: str | None = None, available_now: bool = False,
               processing_time: str | None = None, query_name: str | None = None,
               **params) -> StreamingQuery:
    """Start one mart query.  With ``output`` every trigger rewrites the mart
    there (one sorted file); without it the mart is a memory table named
    ``query_name`` (default: the mart name)."""
    df = mart_stream(trips, name, **params)
    w = (df.writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint or (
             f"{output.rstrip('/')}-checkpoint-{name}" if output is not None
             else scratch_path(spark, f"stream-{name}"))))
    if output is not None:
        keys = S.MART_KEYS.get(name) or None
        writer = W.WRITERS[fmt]
        extra = {"mart": name} if fmt == "tsv" else {}

        def write_batch(batch: DataFrame, _epoch: int) -> None:
            writer(batch, output, order_by=keys, single_file=True, **extra)  # a mart: bounded
        w = w.foreachBatch(write_batch)
    else:
        w = w.format("memory").queryName(query_name or name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
