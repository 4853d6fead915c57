"""Reconciliation of a raw input (X3): what was read, and what became of it.

One pass over the raw files gives both the marts and the audit: every
record is typed, its defects are flags, the flags and the marts' conditions are
counted by ``observe`` while the records stream into the aggregation of
``plans.shared``, whose groups are written as a table.  The report sets the observed count of each mart beside
the trips in the written groups; they differ only if Spark ran a task's
counters twice after a failure, while the groups are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators import marts as A
from farebox.plans import shared as SH
from farebox.session import scratch_path
from farebox.sources import text as TX

READ, HEADERS, ODD_LENGTH = "lignes_lues", "lignes_entete", "lignes_longueur"
UNREADABLE, ACCEPTED = "illisible:", "accepte:"
# The typed fields that the marts read; the departure zone is a text key, which any text is.
FIELDS = [S.PICKUP, S.DROPOFF, "passenger_count", "trip_distance", "DOLocationID", "payment_type", "fare_amount", "tip_amount",
          "total_amount"]
READ_BY_MARTS = [*FIELDS, S.ZONE]
_CORRUPT, _RAW = "_corrupt", "_raw_"


def flagged_trips(raw: DataFrame) -> DataFrame:
    """Typed records (the fields that the marts read) of a raw read with a corrupt-record column, and their
    flags: ``_header``, ``_odd`` (too few or too many fields), ``_bad_<field>``."""
    header = F.col("VendorID").eqNullSafe(F.lit(S.HEADER_MARKER))
    typed = [TX.typed_text(n, t).alias(n) for n, t in S.TRIP_COLUMNS if n in READ_BY_MARTS]
    texts = [F.nullif(F.trim(n), F.lit("")).alias(f"{_RAW}{n}") for n in FIELDS]
    # from a generator, so that a field's text rule is evaluated once and not wherever the field is used
    record = F.struct(*typed, *texts, header.alias("_header"), F.col(_CORRUPT).isNotNull().alias("_odd"))
    out = raw.select(F.inline(F.array(record)))
    flags = [(F.col(f"{_RAW}{n}").isNotNull() & F.col(n).isNull()).alias(f"_bad_{n}") for n in FIELDS]
    return out.select(*READ_BY_MARTS, "_header", "_odd", *flags)


def _metrics(params: dict) -> list[Column]:
    record = ~F.col("_header")
    counts = {READ: F.lit(True), HEADERS: F.col("_header"), ODD_LENGTH: record & F.col("_odd")}
    counts |= {UNREADABLE + n: record & F.col(f"_bad_{n}") for n in FIELDS}
    counts |= {ACCEPTED + m: record & c for m, c in SH.mart_conditions(**params).items()}
    return [F.count_if(c).alias(n) for n, c in counts.items()]


def reconcile(spark: SparkSession, path: str | list[str], *, rounding: str = "sql", read_options: dict | None = None,
              groups_path: str | None = None, **params) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The report and the marts of a raw directory, from one scan.  Report:
    ``mesure``, ``nb``, and for marts ``nb_mart`` (trips in the mart's groups) and ``concorde``."""
    raw = TX.read_raw_trips(spark, path, corrupt_column=_CORRUPT, **(read_options or {}))
    seen = Observation("reconciliation")
    flagged = A.with_timing(flagged_trips(raw))
    timed = flagged.observe(seen, *_metrics(params))
    trips = timed.where(~F.col("_header")).select(*READ_BY_MARTS, "duree_s", "vitesse_mph")
    groups = SH.aggregate_entries(SH.mart_entries(trips, rounding=rounding, **params))
    target = groups_path or scratch_path(spark, "reconciliation")
    groups.write.mode("overwrite").parquet(target)
    groups = spark.read.schema(groups.schema).parquet(target)

    # without a single trip adaptive execution drops the plan's counters with its empty result
    counts = flagged.agg(*_metrics(params)).first().asDict() if groups.isEmpty() else seen.get
    rows = [(i, n, k, SH.MART_IDS.get(n.removeprefix(ACCEPTED))) for i, (n, k) in enumerate(counts.items())]
    report = spark.createDataFrame(rows, "ordre int, mesure string, nb long, m int")   # a row per measure
    written = groups.groupBy("m").agg(F.sum("n").alias("k"))
    nb_mart = F.when(F.col("report.m").isNotNull(), F.coalesce(F.col("k"), F.lit(0)))
    report = (report.alias("report").join(written.alias("w"), F.col("report.m") == F.col("w.m"), "left").orderBy("ordre")
              .select("mesure", "nb", nb_mart.alias("nb_mart"), (nb_mart == F.col("nb")).alias("concorde")))
    return report, SH.marts_from_groups(groups, rounding=rounding)
