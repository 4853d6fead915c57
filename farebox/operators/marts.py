"""The nine aggregate marts (A1-A9) as ``DataFrame -> DataFrame`` functions.

Each one is a single ``filter -> groupBy -> agg`` that Catalyst turns into
scan (pruned columns, pushed filters) -> partial HashAggregate -> exchange on
the group key -> final HashAggregate.  The partial (map-side) aggregation
means every scan task ships at most one row per key, so a key holding a
third of all trips costs no more shuffle than any other key.

Thresholds are keyword parameters whose defaults are the reference values.
The three marts the reference computed in Python accept ``rounding="python"``
(exact binary value, half-even, as Python's ``:.2f``) besides the default
``"sql"`` (decimal half-up, as SQL ``ROUND``); they differ only at ties.
``sort=True`` gives the reference output order (the single reducer's key
order, or the ORDER BY of the SQL query); the sort runs on the aggregated
mart, never on trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.functions import columns as C
from farebox.functions import predicates as PR


def _order(df: DataFrame, sort: bool, *cols) -> DataFrame:
    return df.orderBy(*cols) if sort else df


def with_timing(trips: DataFrame) -> DataFrame:
    """Add ``duree_s`` (exact elapsed seconds) and ``vitesse_mph`` to every
    trip.  The elapsed time is produced by a one-element ``inline`` (a
    Generate node), so it is evaluated once per trip: the optimizer keeps it
    as a column instead of re-deriving the timestamp arithmetic inside every
    predicate and aggregate that reads it.  Speed is then plain arithmetic
    on that column.  Filters on the original columns are still pushed below
    the Generate into the scan."""
    secs = F.struct(C.duration_seconds().alias("duree_s"))
    timed = trips.select(*trips.columns, F.inline(F.array(secs)))
    return timed.withColumn(
        "vitesse_mph", F.try_divide(F.col("trip_distance"), F.col("duree_s") / F.lit(3600.0)))


# --------------------------------------------------------------------------
# A1 - trips per pickup hour (every record whose pickup parses)
# --------------------------------------------------------------------------
def trips_per_hour(trips: DataFrame, *, sort: bool = True) -> DataFrame:
    # group on the hour number; the 'HH' label is built on the 24 result rows
    out = (trips.filter(PR.has_pickup())
           .groupBy(F.hour(S.PICKUP).alias("h"))
           .agg(F.count(F.lit(1)).alias("nb_courses"))
           .select(C.hour_label("h").alias("heure"), "nb_courses"))
    return _order(out, sort, "heure")


# --------------------------------------------------------------------------
# A2 - revenue per departure zone; tip rate is a ratio of sums
# --------------------------------------------------------------------------
def revenue_per_zone(trips: DataFrame, *, max_amount: float = S.MAX_AMOUNT,
                     sort: bool = True, rounding: str = "sql") -> DataFrame:
    fare, tip, total = F.col("fare_amount"), F.col("tip_amount"), F.col("total_amount")
    r = C.rounder(rounding)
    # The zone is any non-empty key: an INT where the source is typed, the
    # trimmed text of the field where the source is text.
    # The filter makes fare, tip and total non-NULL: means are sums over the
    # trip count (what avg computes), four buffers for all outputs.
    n, sf, st, sa = F.col("nb_courses"), F.col("s_fare"), F.col("s_tip"), F.col("s_total")
    out = (trips.filter(PR.zone_revenue_ok(max_amount))
           .groupBy("PULocationID")
           .agg(F.count(F.lit(1)).alias("nb_courses"), F.sum(fare).alias("s_fare"),
                F.sum(tip).alias("s_tip"), F.sum(total).alias("s_total"))
           .select(F.col("PULocationID").cast("string").alias("zone_depart"), n,
                   r(sf / n, 2).alias("tarif_moyen"),
                   r(st / n, 2).alias("pourboire_moyen"),
                   r(sa / n, 2).alias("montant_moyen"),
                   r(C.ratio_pct(st, sf), 1).alias("taux_pourboire")))
    return _order(out, sort, "zone_depart")


# --------------------------------------------------------------------------
# A3 - speed / congestion per weekday-hour slot (per-trip speeds)
# --------------------------------------------------------------------------
def speed_analysis(trips: DataFrame, *, max_speed: float = S.MAX_SPEED_MPH,
                   sort: bool = True, rounding: str = "sql") -> DataFrame:
    secs, speed = F.col("duree_s"), F.col("vitesse_mph")
    r = C.rounder(rounding)
    # The filter makes distance, duration and speed non-NULL: means are sums
    # over the trip count (what avg computes).
    n = F.col("nb_courses")
    out = (with_timing(trips).filter(PR.speed_ok(max_speed, seconds=secs, speed=speed))
           .groupBy(F.weekday(S.PICKUP).alias("j"), F.hour(S.PICKUP).alias("h"))
           .agg(F.count(F.lit(1)).alias("nb_courses"),
                F.sum("trip_distance").alias("s_dist"), F.sum(secs / F.lit(3600.0)).alias("s_hours"),
                F.sum(speed).alias("s_speed"), F.min(speed).alias("lo"), F.max(speed).alias("hi"))
           .select(C.slot_label("j", "h", S.DAYS_SHORT).alias("creneau"), n,
                   r(F.col("s_dist") / n, 2).alias("distance_moyenne"),
                   r(F.col("s_hours") / n * F.lit(60.0), 1).alias("duree_moyenne_min"),
                   r(F.col("s_speed") / n, 1).alias("vitesse_moyenne_mph"),
                   r(F.col("lo"), 1).alias("vitesse_min"),
                   r(F.col("hi"), 1).alias("vitesse_max")))
    return _order(out, sort, "creneau")


# --------------------------------------------------------------------------
# A4 - revenue per weekday-hour slot; fare and tip are rounded to cents
# before they are summed, "recette_totale" is the sum of fares
# --------------------------------------------------------------------------
def peak_revenue(trips: DataFrame, *, max_amount: float = S.MAX_AMOUNT,
                 sort: bool = True, rounding: str = "sql") -> DataFrame:
    r = C.rounder(rounding)
    # per-trip cents: plain ROUND of the input value (no float noise to snap),
    # or the exact text rule at a per-trip string cost
    fare2, tip2 = C.trip_cents("fare_amount", rounding), C.trip_cents("tip_amount", rounding)
    # The filter guarantees a non-NULL fare and tip on every kept trip, so
    # each mean is the group's sum over its trip count (what avg computes),
    # and three aggregation buffers serve all five outputs.
    n, sf, st = F.col("nb_courses"), F.col("s_fare"), F.col("s_tip")
    out = (trips.filter(PR.peak_revenue_ok(max_amount))
           .groupBy(F.weekday(S.PICKUP).alias("j"), F.hour(S.PICKUP).alias("h"))
           .agg(F.count(F.lit(1)).alias("nb_courses"),
                F.sum(fare2).alias("s_fare"), F.sum(tip2).alias("s_tip"))
           .select(C.slot_label("j", "h", S.DAYS_LONG).alias("creneau"), n,
                   r(sf / n, 2).alias("fare_moy"),
                   r(st / n, 2).alias("tip_moy"),
                   r(C.ratio_pct(st, sf), 1).alias("tip_rate"),
                   r(sf, 2).alias("recette_totale")))
    return _order(out, sort, "creneau")


# --------------------------------------------------------------------------
# A5 - payment breakdown; tip rate is a mean of per-trip ratios
# --------------------------------------------------------------------------
def payment_methods(trips: DataFrame, *, max_amount: float = S.MAX_AMOUNT,
                    sort: bool = True) -> DataFrame:
    fare, tip = F.col("fare_amount"), F.col("tip_amount")
    # The filter makes fare, tip and the tip/fare ratio non-NULL: their means
    # are sums over the trip count (what avg computes).  The total is not
    # filtered and may be NULL: its sum skips NULLs, as SUM does.
    n = F.col("nb_courses")
    out = (trips.filter(PR.payment_ok(max_amount))
           .groupBy("payment_type")
           .agg(F.count(F.lit(1)).alias("nb_courses"),
                F.sum(fare).alias("s_fare"), F.sum(tip).alias("s_tip"),
                F.sum(tip / F.nullif(fare, F.lit(0.0))).alias("s_ratio"),
                F.sum("total_amount").alias("s_total"))
           .select(C.payment_label("payment_type").alias("mode_paiement"), n,
                   C.round_half_up(F.col("s_fare") / n, 2).alias("tarif_moyen"),
                   C.round_half_up(F.col("s_tip") / n, 2).alias("pourboire_moyen"),
                   C.round_half_up(F.col("s_ratio") / n * F.lit(100.0), 1).alias("taux_pourboire_pct"),
                   C.round_half_up(F.col("s_total"), 0).alias("recette_totale")))
    return _order(out, sort, F.desc("nb_courses"), F.asc_nulls_last("mode_paiement"))


# --------------------------------------------------------------------------
# A6 - origin-destination flows (top-n by trips, ties broken by the pair)
# --------------------------------------------------------------------------
def od_flows(trips: DataFrame, *, top: int | None = 20, sort: bool = True) -> DataFrame:
    out = (trips.filter(PR.od_ok())
           .groupBy(C.zone_number("PULocationID").alias("zone_depart"),
                    F.col("DOLocationID").alias("zone_arrivee"))
           .agg(F.count(F.lit(1)).alias("nb_courses"),
                C.round_half_up(F.avg("trip_distance"), 2).alias("dist_moy_miles"),
                C.round_half_up(F.avg("fare_amount"), 2).alias("tarif_moy"),
                C.round_half_up(F.avg("tip_amount"), 2).alias("pourboire_moy")))
    order = [F.desc("nb_courses"), F.asc("zone_depart"), F.asc("zone_arrivee")]
    if top is not None:
        # orderBy + limit plans as TakeOrderedAndProject: a bounded top-n per
        # partition, then one merge of (partitions x n) rows.
        return out.orderBy(*order).limit(top)
    return _order(out, sort, "zone_depart", "zone_arrivee")


# --------------------------------------------------------------------------
# A7 - weekly revenue of one calendar year (ISO week number, calendar year)
# --------------------------------------------------------------------------
def weekly_revenue(trips: DataFrame, *, year: int = S.WEEKLY_YEAR,
                   max_amount: float = S.MAX_AMOUNT, sort: bool = True) -> DataFrame:
    d = F.to_date(S.PICKUP)
    total = F.col("total_amount")
    if "pickup_year" in trips.columns:
        # staged table (farebox.plans.storage): prune to the year's partitions
        trips = trips.filter(F.col("pickup_year") == year)
    out = (trips.filter(PR.weekly_ok(year, max_amount))
           .groupBy(F.year(d).alias("annee"), F.weekofyear(d).alias("semaine"))
           .agg(F.count(F.lit(1)).alias("nb_courses"),
                C.round_half_up(F.sum(total), 0).alias("recette_totale"),
                C.round_half_up(F.avg(total), 2).alias("recette_moyenne"),
                C.round_half_up(F.avg("trip_distance"), 2).alias("distance_moyenne"),
                C.round_half_up(F.avg("passenger_count"), 2).alias("passagers_moyens"))
           .select("semaine", "annee", "nb_courses", "recette_totale",
                   "recette_moyenne", "distance_moyenne", "passagers_moyens"))
    return _order(out, sort, "annee", "semaine")


# --------------------------------------------------------------------------
# A8 - suspicious-trip count (long distance, under a minute or negative)
# --------------------------------------------------------------------------
def suspicious_trips(trips: DataFrame, *, min_miles: float = S.SUSPICIOUS_MIN_MILES,
                     max_seconds: int = S.SUSPICIOUS_MAX_SECONDS) -> DataFrame:
    return (trips.filter(PR.suspicious(min_miles, max_seconds))
            .agg(F.count(F.lit(1)).alias("courses_suspectes")))


# --------------------------------------------------------------------------
# P9 / A9 - peak versus off-peak
# --------------------------------------------------------------------------
def with_period(trips: DataFrame) -> DataFrame:
    """The view: every trip column plus ``periode``."""
    return trips.withColumn("periode", C.period_label(S.PICKUP))


def peak_vs_offpeak(trips: DataFrame, *, max_amount: float = S.MAX_AMOUNT,
                    sort: bool = True) -> DataFrame:
    out = (with_period(trips).filter(PR.peak_offpeak_ok(max_amount))
           .groupBy("periode")
           .agg(F.count(F.lit(1)).alias("nb_courses"),
                C.round_half_up(F.avg("fare_amount"), 2).alias("recette_moy"),
                C.round_half_up(F.avg("tip_amount"), 2).alias("pourboire_moy"),
                C.round_half_up(F.sum("total_amount"), 0).alias("recette_totale")))
    return _order(out, sort, F.desc("recette_totale"), F.asc("periode"))


# --------------------------------------------------------------------------
# A10 - row count of the fact table
# --------------------------------------------------------------------------
def total_trips(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("nb_lignes"))


MARTS = {
    "trips_per_hour": trips_per_hour,
    "revenue_per_zone": revenue_per_zone,
    "speed_analysis": speed_analysis,
    "peak_revenue": peak_revenue,
    "payment_methods": payment_methods,
    "od_flows": od_flows,
    "weekly_revenue": weekly_revenue,
    "suspicious_trips": suspicious_trips,
    "peak_vs_offpeak": peak_vs_offpeak,
}
