"""Registered queries: name -> (DataFrame builder over the benchmark tables,
equivalent SQL for the independent oracle or None).

Every builder reads ``{sf_dir}/lineitem.parquet`` through the ``trips``
derivation, i.e. the whole table; none samples, caps or filters by id."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.extensions import user_marts as UM
from farebox.functions import columns as C
from farebox.functions.parsing import coerce_numeric
from farebox.operators import kpis as K
from farebox.operators import marts as A
from farebox.operators import weekly as WK
from farebox.operators import zones as Z
from farebox.plans import audit as AU
from farebox.plans import incremental as INC
from farebox.plans import shared as SH
from farebox.plans import sql as Q
from farebox.plans.catalog import MartCatalog
from farebox.session import scratch_path
from farebox.sinks import publish as PB
from farebox.sources import deliveries as DL
from farebox.sources import dirty as D
from farebox.sources import lineitem as L
from farebox.sources import marts as MS
from farebox.sources import text as TX
from farebox.streaming import event_time as EV


@dataclass(frozen=True)
class Registered:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def _mart(fn, **kw):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(L.load_trips(spark, sf_dir), **kw)
    return build


def _over(mart_fn, op, **kw):
    """A mart-level operator applied to a mart built from the trips."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(mart_fn(L.load_trips(spark, sf_dir)), **kw)
    return build


def _kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI table from one scan of the trips (``plans.shared``); equal to
    ``kpis.kpi_summary`` over the seven marts it reads (tested), which
    would scan the fact table seven times."""
    return SH.kpi_summary_one_pass(L.load_trips(spark, sf_dir))


def _period_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.with_period(L.load_trips(spark, sf_dir))


def _text_round_trip(mart_fn):
    """The whole table written as raw CSV files and read back by the text
    source, then the mart: the scan reads the fields of the mart only."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = D.text_files(TX.trips_as_text(L.load_trips(spark, sf_dir)), "text-trips")
        return mart_fn(TX.read_trips_text(spark, path))
    return build


def _dirty(mart_fn, load=D.load_dirty_trips):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mart_fn(load(spark, sf_dir))
    return build


def _reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = AU.reconcile(spark, D.dirty_files(spark, sf_dir, numbers=True), weekly_year=L.TEST_WEEKLY_YEAR)
    return report


def _reconciled_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of the audit's own pass."""
    return AU.reconcile(spark, D.dirty_files(spark, sf_dir, numbers=True))[1]["revenue_per_zone"]


def _input_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the table, counted file by file (SQL over a view knows no files)."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    profile = MS.input_profile(spark, path, rows=spark.read.parquet(path))
    return profile.agg(F.sum("lignes").alias("lignes"))


def _kpi_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of ``kpis.kpi_dict`` as one text, entries in the order of their keys."""
    entries = F.array_sort(F.map_entries("kpis"))
    return K.kpi_dict(_kpi_summary(spark, sf_dir)).select(F.array_join(F.transform(
        entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ").alias("kpis"))


# --- marts written to files and read back ------------------------------------
def _exported(spark: SparkSession, sf_dir: str, mart: str, fmt: str) -> DataFrame:
    path = scratch_path(spark, f"{mart}-{fmt}")
    MartCatalog(L.load_trips(spark, sf_dir)).export(mart, path, fmt)
    reader = {"tsv": MS.read_mart_tsv, "csv": MS.read_mart_csv, "json": MS.read_mart_json}[fmt]
    return reader(spark, path, mart)


def _slot_report_from_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = K.slot_report(_exported(spark, sf_dir, "peak_revenue", "tsv"))
    line = ["creneau", "nb_courses", "recette_totale"]
    totals = report["totals"].withColumn("creneau", F.lit("TOTAL"))
    return report["top5"].select(*line).unionByName(totals.select(*line))


def _read_back_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MS.read_back_top(_exported(spark, sf_dir, "revenue_per_zone", "tsv"), "nb_courses", 10, key=["zone_depart"])


def _kpi_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI table followed by one row per payment label."""
    payments = A.payment_methods(L.load_trips(spark, sf_dir), sort=False)
    extra = payments.select(F.col("mode_paiement").alias("indicateur"), F.col("nb_courses").cast("string").alias("valeur"))
    return K.append_kpis(_kpi_summary(spark, sf_dir), extra)


def _coerced_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot mart as text with unparsable means where the trip count is
    odd, coerced back to numbers."""
    peak = A.peak_revenue(L.load_trips(spark, sf_dir))
    text = peak.withColumns({
        "fare_moy": F.when(F.col("nb_courses") % 2 == 1, "n/a").otherwise(F.col("fare_moy").cast("string")),
        "tip_moy": F.col("tip_moy").cast("string")})
    return coerce_numeric(text, ["fare_moy", "tip_moy"])


# --- marts kept up to date in batch, marts published as a whole ------------------
def _incremental(mart: str):
    """The table arrives in two halves of text files; the second build reads the files of the second half only."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_path(spark, "incremental")
        lineitem = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
        for half in (0, 1):
            lines = TX.trips_as_text(L.trips_from_lineitem(lineitem.where(F.col("l_orderkey") % 2 == half)))
            lines.write.mode("append").text(f"{base}/raw")
            built = INC.build(spark, f"{base}/raw", f"{base}/store", weekly_year=L.TEST_WEEKLY_YEAR)
        return built.marts[mart]
    return build


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "published")
    cat = MartCatalog(L.load_trips(spark, sf_dir))
    cat.publish(out, "json", names=["peak_vs_offpeak"])
    return PB.read_published(spark, out, "peak_vs_offpeak", "json")


# --- a user's own aggregate -------------------------------------------------------
def _median_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = UM.median_fare(L.load_trips(spark, sf_dir), "payment_type", max_amount=S.MAX_AMOUNT)
    return medians.select(C.payment_label("payment_type").alias("mode_paiement"), "nb_courses", "mediane")


# --- marts joined with a zone lookup --------------------------------------------
def _named(mart_fn, column, prefix=""):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        out, zones = mart_fn(L.load_trips(spark, sf_dir)), L.load_zones(spark, sf_dir)
        for c, p in zip([column] if isinstance(column, str) else column, [prefix] if isinstance(prefix, str) else prefix):
            out = Z.with_zone_names(out, zones, c, p)
        return out
    return build


def _district_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.revenue_per_district(L.load_trips(spark, sf_dir), L.load_zones(spark, sf_dir))


# --- hours of event time from a stream ----------------------------------------
def _stream_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each delivery lands and is taken by an available-now run that goes on
    from the state of the one before.  Returns what landed and the closed hours."""
    base = scratch_path(spark, "events")
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    for _ in DL.deliver(spark, sf_dir, f"{base}/landing"):
        arrived = spark.readStream.schema(schema).parquet(f"{base}/landing")
        EV.start_windows(arrived, f"{base}/hours", state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/landing"), EV.read_windows(spark, f"{base}/hours")


def _events_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_events(spark, sf_dir)[1]


def _late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.account(*_stream_events(spark, sf_dir))


_CAL = "['" + "', '".join(Q.S.DAYS_SHORT) + "']"

REGISTRY: dict[str, Registered] = {
    # --- the nine marts -----------------------------------------------------
    "trips_per_hour": Registered(_mart(A.trips_per_hour), Q.mart_query("trips_per_hour", "heure")),
    "revenue_per_zone": Registered(_mart(A.revenue_per_zone), Q.mart_query("revenue_per_zone", "zone_depart")),
    "speed_analysis": Registered(_mart(A.speed_analysis), Q.mart_query("speed_analysis", "creneau")),
    "peak_revenue": Registered(_mart(A.peak_revenue), Q.mart_query("peak_revenue", "creneau")),
    "payment_methods": Registered(_mart(A.payment_methods),
                                  Q.mart_query("payment_methods", "nb_courses DESC, mode_paiement NULLS LAST")),
    "od_flows": Registered(_mart(A.od_flows, top=None),
                           Q.mart_query("od_flows", "zone_depart, zone_arrivee")),
    "od_flows_top20": Registered(_mart(A.od_flows, top=20),
                                 Q.mart_query("od_flows", "nb_courses DESC, zone_depart, zone_arrivee", 20)),
    "weekly_revenue": Registered(_mart(A.weekly_revenue, year=L.TEST_WEEKLY_YEAR),
                                 Q.mart_query("weekly_revenue", "annee, semaine")),
    "suspicious_trips": Registered(_mart(A.suspicious_trips), Q.mart_query("suspicious_trips")),
    "peak_vs_offpeak": Registered(_mart(A.peak_vs_offpeak),
                                  Q.mart_query("peak_vs_offpeak", "recette_totale DESC, periode")),
    "total_trips": Registered(_mart(A.total_trips), Q.with_marts("SELECT COUNT(*) AS nb_lignes FROM trips")),
    # --- operators over marts -----------------------------------------------
    "report_totals": Registered(
        _over(partial(A.peak_revenue, sort=False), K.report_totals),
        Q.with_marts("""SELECT COUNT(*) AS nb_creneaux, CAST(SUM(nb_courses) AS BIGINT) AS nb_courses,
                        RND(SUM(recette_totale), 2) AS recette_totale FROM peak_revenue""", "peak_revenue")),
    "top5_slots": Registered(
        _over(A.peak_revenue, K.top5_slots),
        Q.mart_query("peak_revenue", "recette_totale DESC NULLS LAST, creneau", 5)),
    "top_revenue_slots": Registered(
        _over(A.peak_revenue, K.top_revenue_slots, n=10),
        Q.mart_query("peak_revenue", "recette_totale DESC NULLS LAST, creneau", 10)),
    "best_slot": Registered(
        _over(A.peak_revenue, K.best_slot),
        Q.mart_query("peak_revenue", "recette_totale DESC NULLS LAST, creneau", 1)),
    "dominant_payment": Registered(
        _over(A.payment_methods, K.dominant_payment),
        Q.with_marts("""SELECT mode_paiement, nb_courses FROM payment_methods
                        ORDER BY nb_courses DESC NULLS LAST, mode_paiement NULLS LAST LIMIT 1""",
                     "payment_methods")),
    "payment_share": Registered(
        _over(partial(A.payment_methods, sort=False), K.payment_share),
        Q.with_marts("""SELECT mode_paiement, nb_courses,
                        RND(nb_courses / (SELECT SUM(nb_courses) FROM payment_methods) * 100.0, 1) AS part_pct
                        FROM payment_methods""", "payment_methods")),
    "top_zones": Registered(
        _over(A.revenue_per_zone, K.top_zones, n=10),
        Q.mart_query("revenue_per_zone", "nb_courses DESC NULLS LAST, zone_depart", 10)),
    "top_speed_slots": Registered(
        _over(A.speed_analysis, K.top_speed_slots, n=15),
        Q.mart_query("speed_analysis", "vitesse_moyenne_mph DESC NULLS LAST, creneau", 15)),
    "fastest_slowest_slot": Registered(
        _over(A.speed_analysis, K.fastest_slowest_slot),
        Q.with_marts(f"""SELECT * FROM (SELECT '{K.FASTEST}' AS indicateur, creneau, vitesse_moyenne_mph,
                           RND(vitesse_moyenne_mph * {Q.S.MILES_TO_KM}, 1) AS vitesse_moyenne_kmh
                         FROM speed_analysis ORDER BY vitesse_moyenne_mph DESC NULLS LAST, creneau LIMIT 1) a
                         UNION ALL
                         SELECT * FROM (SELECT '{K.SLOWEST}' AS indicateur, creneau, vitesse_moyenne_mph,
                           RND(vitesse_moyenne_mph * {Q.S.MILES_TO_KM}, 1) AS vitesse_moyenne_kmh
                         FROM speed_analysis ORDER BY vitesse_moyenne_mph ASC NULLS LAST, creneau LIMIT 1) b""",
                     "speed_analysis")),
    "busiest_hour": Registered(
        _over(A.trips_per_hour, K.busiest_hour),
        Q.mart_query("trips_per_hour", "nb_courses DESC NULLS LAST, heure", 1)),
    "mean_speed_kpi": Registered(
        _over(partial(A.speed_analysis, sort=False), K.mean_speed_kpi),
        Q.with_marts(f"""SELECT RND(AVG(vitesse_moyenne_mph), 2) AS vitesse_moyenne_mph,
                           RND(AVG(vitesse_moyenne_mph) * {Q.S.MILES_TO_KM}, 1) AS vitesse_moyenne_kmh,
                           RND(SUM(vitesse_moyenne_mph * nb_courses) / SUM(nb_courses), 2) AS vitesse_ponderee_mph
                         FROM speed_analysis""", "speed_analysis")),
    "speed_calendar_order": Registered(
        _over(A.speed_analysis, K.calendar_order),
        Q.with_marts(f"""SELECT *, CAST((list_position({_CAL}, split_part(creneau, '-', 1)) - 1) * 24
                           + CAST(split_part(creneau, '-', 2) AS INTEGER) AS INTEGER) AS ordre
                         FROM speed_analysis ORDER BY ordre""", "speed_analysis")),
    "weekly_series": Registered(
        _over(lambda t: A.weekly_revenue(t, year=L.TEST_WEEKLY_YEAR), K.weekly_series),
        Q.with_marts("""SELECT annee, semaine, nb_courses, recette_totale FROM weekly_revenue
                        ORDER BY annee, semaine""", "weekly_revenue")),
    "kpi_summary": Registered(_kpi_summary, Q.KPI_SUMMARY_SQL),
    # The KPI table as a dictionary; U1: rows appended to it
    "kpi_dict": Registered(_kpi_dict, Q.KPI_DICT_SQL),
    "kpi_union": Registered(_kpi_union, Q.KPI_UNION_SQL),
    # A dashboard table preview, first 20 rows in the mart's key order
    "zone_preview": Registered(
        _over(A.revenue_per_zone, K.preview, key=["zone_depart"], n=20),
        Q.mart_query("revenue_per_zone", "zone_depart", 20)),
    "period_view": Registered(
        _period_view, Q.with_marts(f"SELECT *, {Q.PERIOD} AS periode FROM trips")),
    # --- text ingestion path over the whole table ------------------------------
    "peak_revenue_from_text": Registered(
        _text_round_trip(A.peak_revenue), Q.mart_query("peak_revenue", "creneau")),
    "speed_analysis_from_text": Registered(
        _text_round_trip(A.speed_analysis), Q.mart_query("speed_analysis", "creneau")),
    # --- dirty text: header lines, short records, bad and padded fields --------
    "dirty_text_hours": Registered(_dirty(A.trips_per_hour), Q.dirty_query("trips_per_hour", "heure")),
    "dirty_text_zones": Registered(_dirty(A.revenue_per_zone), Q.dirty_query("revenue_per_zone", "zone_depart")),
    "dirty_text_peak": Registered(_dirty(A.peak_revenue), Q.dirty_query("peak_revenue", "creneau")),
    # the same records with line ends inside quotes, by both typings
    "multi_line_zones": Registered(
        _dirty(A.revenue_per_zone, D.load_multi_line_trips), Q.dirty_query("revenue_per_zone", "zone_depart")),
    "multi_line_peak": Registered(
        _dirty(A.peak_revenue, partial(D.load_multi_line_trips, text_rules=True)), Q.dirty_query("peak_revenue", "creneau")),
    # odd number forms, by the rules of the staged path
    "staged_numbers_zones": Registered(
        _dirty(A.revenue_per_zone, D.load_staged_trips), Q.dirty_query("revenue_per_zone", "zone_depart", numbers=True)),
    # --- X3: what was read, unreadable, accepted; a mart of the same pass ----------
    "reconciliation": Registered(_reconciliation, Q.reconciliation_sql()),
    "reconciled_zones": Registered(
        _reconciled_zones, Q.dirty_query("revenue_per_zone", "zone_depart", numbers=True)),
    # --- marts written to files and read back ----------------------------------
    "slot_report_from_tsv": Registered(
        _slot_report_from_tsv,
        Q.with_marts("""SELECT * FROM (SELECT creneau, nb_courses, recette_totale FROM peak_revenue
                          ORDER BY recette_totale DESC NULLS LAST, creneau LIMIT 5) t
                        UNION ALL
                        SELECT 'TOTAL' AS creneau, CAST(SUM(nb_courses) AS BIGINT), RND(SUM(recette_totale), 2)
                        FROM peak_revenue""", "peak_revenue")),
    "read_back_zones": Registered(
        _read_back_zones, Q.mart_query("revenue_per_zone", "nb_courses DESC, zone_depart", 10)),
    "csv_mart_round_trip": Registered(
        lambda spark, sf_dir: _exported(spark, sf_dir, "payment_methods", "csv"), Q.mart_query("payment_methods")),
    "json_mart_round_trip": Registered(
        lambda spark, sf_dir: _exported(spark, sf_dir, "speed_analysis", "json"), Q.mart_query("speed_analysis")),
    "coerced_mart": Registered(
        _coerced_mart,
        Q.with_marts("""SELECT creneau, nb_courses, CASE WHEN nb_courses % 2 = 1 THEN NULL ELSE fare_moy END AS fare_moy,
                        tip_moy, tip_rate, recette_totale FROM peak_revenue""", "peak_revenue")),
    # --- input profile ---------------------------------------------------------
    "input_profile": Registered(_input_profile, Q.with_marts("SELECT CAST(COUNT(*) AS BIGINT) AS lignes FROM trips")),
    # --- X5: hours of event time from a stream, late rows dropped ----------------
    "events_per_hour": Registered(_events_per_hour, Q.EVENTS_PER_HOUR_SQL),
    "late_events": Registered(_late_events, Q.LATE_EVENTS_SQL),
    # --- X1: zone names --------------------------------------------------------
    "zone_revenue_named": Registered(
        _named(A.revenue_per_zone, "zone_depart"),
        Q.with_zones("""SELECT m.*, nom, quartier FROM revenue_per_zone m LEFT JOIN zones ON zone_depart = cle""", "revenue_per_zone")),
    "od_flows_named": Registered(
        _named(partial(A.od_flows, top=None), ["zone_depart", "zone_arrivee"], ["depart_", "arrivee_"]),
        Q.with_zones("""SELECT m.*, a.nom AS depart_nom, a.quartier AS depart_quartier, b.nom AS arrivee_nom,
                        b.quartier AS arrivee_quartier FROM od_flows m
                        LEFT JOIN zones a ON CAST(zone_depart AS VARCHAR) = a.cle
                        LEFT JOIN zones b ON CAST(zone_arrivee AS VARCHAR) = b.cle""", "od_flows")),
    "revenue_per_district": Registered(_district_revenue, Q.DISTRICT_SQL),
    # --- X4, X2: weeks without gaps, unusual weeks --------------------------------
    "iso_weeks": Registered(_mart(WK.iso_weeks), Q.ISO_WEEKS_SQL),
    "weekly_anomalies": Registered(_mart(WK.weekly_anomalies), Q.weekly_anomalies_sql()),
    "zone_weekly_anomalies": Registered(_mart(WK.weekly_anomalies, by=["PULocationID"]), Q.weekly_anomalies_sql("PULocationID")),
    # --- A1-A9 kept up to date from new files; S9/S13 published with a pointer ------
    "incremental_slots": Registered(_incremental("peak_revenue"), Q.mart_query("peak_revenue", "creneau")),
    "incremental_speed": Registered(_incremental("speed_analysis"), Q.mart_query("speed_analysis", "creneau")),
    "incremental_weeks": Registered(_incremental("weekly_revenue"), Q.mart_query("weekly_revenue", "annee, semaine")),
    "published_mart": Registered(_published, Q.mart_query("peak_vs_offpeak")),
    # --- 2.10: a user's own aggregate, in pandas ------------------------------------
    "median_fares": Registered(_median_fares, Q.MEDIAN_FARES_SQL),
}

# The queries that run a user's Python; all others are built-in expressions.
USER_PYTHON = {"median_fares"}
