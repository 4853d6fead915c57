"""All marts from one scan of the trips.

The nine marts read the same fact table with different filters and keys.
Run separately they cost nine scans; here each trip is turned into one
entry per mart whose filter it passes (mart id, key parts, measures) and a
single ``groupBy(mart, key)`` aggregates them all.  Catalyst plans that as one
scan -> Generate -> partial HashAggregate (map-side, a few thousand groups in
total) -> one small exchange -> final HashAggregate.  Each mart is then a
projection of the matching groups: averages are sums over non-NULL counts,
exactly what ``avg`` computes.

At scale the scan dominates, so one pass instead of nine is the saving; the
aggregated result is tiny (24 + 168 + 168 + zones + zones^2 + weeks + ...
rows) and can be checkpointed into the shared checkpoint folder so that every
mart built from it survives a lost executor without rescanning the trips.

Why entries and not GROUPING SETS for the marts: with one set per mart key
and one conditional aggregate per mart measure (about 40), every trip is
expanded once per set and each copy updates every aggregate; measured 3x
slower than the entries at sf0.1.  The KPI table needs only counts and two
sums, and there GROUPING SETS is the cheaper form (``kpi_groups``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from farebox import schema as S
from farebox.functions import columns as C
from farebox.functions import predicates as PR
from farebox.operators import marts as A

MART_IDS = {
    "trips_per_hour": 1, "revenue_per_zone": 2, "speed_analysis": 3, "peak_revenue": 4,
    "payment_methods": 5, "od_flows": 6, "weekly_revenue": 7, "suspicious_trips": 8,
    "peak_vs_offpeak": 9, "total_trips": 10,
}
_MEASURES = ("v1", "v2", "v3", "v4")


def _entry(mart: str, cond: Column, *, k1=None, k2=None, ks=None, **measures) -> Column:
    fields = [F.lit(MART_IDS[mart]).cast("tinyint").alias("m"),
              (k1 if k1 is not None else F.lit(None)).cast("int").alias("k1"),
              (k2 if k2 is not None else F.lit(None)).cast("int").alias("k2"),
              (ks if ks is not None else F.lit(None)).cast("string").alias("ks")]
    for v in _MEASURES:
        m = measures.get(v)
        fields.append((m if m is not None else F.lit(None)).cast("double").alias(v))
    return F.when(cond, F.struct(*fields))


def mart_conditions(*, weekly_year: int = S.WEEKLY_YEAR, max_amount: float = S.MAX_AMOUNT, max_speed: float = S.MAX_SPEED_MPH,
                    min_miles: float = S.SUSPICIOUS_MIN_MILES, max_seconds: int = S.SUSPICIOUS_MAX_SECONDS) -> dict[str, Column]:
    """Which trips (with their timing) count in each mart."""
    return {
        "trips_per_hour": PR.has_pickup(),
        "revenue_per_zone": PR.zone_revenue_ok(max_amount),
        "speed_analysis": PR.speed_ok(max_speed, seconds=F.col("duree_s"), speed=F.col("vitesse_mph")),
        "peak_revenue": PR.peak_revenue_ok(max_amount),
        "payment_methods": PR.payment_ok(max_amount),
        "od_flows": PR.od_ok(),
        "weekly_revenue": PR.weekly_ok(weekly_year, max_amount),
        "suspicious_trips": PR.suspicious(min_miles, max_seconds),
        "peak_vs_offpeak": PR.peak_offpeak_ok(max_amount),
        "total_trips": F.lit(True),
    }


def mart_entries(trips: DataFrame, *, rounding: str = "sql", only: set[str] | None = None, **params) -> DataFrame:
    """One row per (trip, mart the trip counts in); ``only`` restricts the
    marts, ``params`` are those of ``mart_conditions``."""
    t = trips if "duree_s" in trips.columns else A.with_timing(trips)
    pu = F.col(S.PICKUP)
    wd, hr = F.weekday(pu), F.hour(pu)
    d = F.to_date(pu)
    fare, tip, total = F.col("fare_amount"), F.col("tip_amount"), F.col("total_amount")
    dist = F.col("trip_distance")
    secs, speed = F.col("duree_s"), F.col("vitesse_mph")
    # an INT zone is a small key; a text zone (text sources) is kept as it is
    text_zone = isinstance(trips.schema[S.ZONE].dataType, StringType)
    fields = {
        "trips_per_hour": dict(k1=hr),
        "revenue_per_zone": {"ks" if text_zone else "k1": F.col(S.ZONE), "v1": fare, "v2": tip, "v3": total},
        "speed_analysis": dict(k1=wd, k2=hr, v1=dist, v2=secs / F.lit(3600.0), v3=speed),
        "peak_revenue": dict(k1=wd, k2=hr, v1=C.trip_cents(fare, rounding), v2=C.trip_cents(tip, rounding)),
        "payment_methods": dict(k1=F.col("payment_type"), v1=fare, v2=tip, v3=total, v4=tip / F.nullif(fare, F.lit(0.0))),
        "od_flows": dict(k1=C.zone_number(S.ZONE), k2=F.col("DOLocationID"), v1=dist, v2=fare, v3=tip),
        "weekly_revenue": dict(k1=F.year(d), k2=F.weekofyear(d), v1=total, v2=dist, v3=F.col("passenger_count")),
        "suspicious_trips": {},
        "peak_vs_offpeak": dict(ks=C.period_label(pu), v1=fare, v2=tip, v3=total),
        "total_trips": {},
    }
    conditions = mart_conditions(**params)
    entries = [_entry(name, conditions[name], **fields[name]) for name in MART_IDS]
    if only is not None:
        entries = [e for name, e in zip(MART_IDS, entries) if name in only]
    return (t.select(F.explode(F.array(*entries)).alias("e"))
            .filter(F.col("e").isNotNull())
            .select("e.*"))


def aggregate_entries(entries: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    for v in _MEASURES:
        aggs += [F.sum(v).alias(f"s_{v}"), F.count(v).alias(f"c_{v}")]
    aggs += [F.min("v3").alias("lo_v3"), F.max("v3").alias("hi_v3")]
    return entries.groupBy("m", "k1", "k2", "ks").agg(*aggs)


def _avg(v: str) -> Column:
    return F.try_divide(F.col(f"s_{v}"), F.col(f"c_{v}").cast("double"))


def _r(c: Column, digits: int) -> Column:
    return C.round_half_up(c, digits)


def marts_from_groups(groups: DataFrame, *, sort: bool = True, rounding: str = "sql") -> dict[str, DataFrame]:
    """The marts (same columns and values as ``farebox.operators.marts``)."""
    job_r = C.rounder(rounding)  # zone revenue, slot speed, slot revenue

    def of(name: str) -> DataFrame:
        return groups.filter(F.col("m") == MART_IDS[name])

    def order(df: DataFrame, *cols) -> DataFrame:
        return df.orderBy(*cols) if sort else df

    n = F.col("n")
    out = {
        "trips_per_hour": order(of("trips_per_hour").select(
            C.hour_label("k1").alias("heure"), n.alias("nb_courses")), "heure"),
        "revenue_per_zone": order(of("revenue_per_zone").select(
            F.coalesce("ks", F.col("k1").cast("string")).alias("zone_depart"), n.alias("nb_courses"),
            job_r(_avg("v1"), 2).alias("tarif_moyen"), job_r(_avg("v2"), 2).alias("pourboire_moyen"),
            job_r(_avg("v3"), 2).alias("montant_moyen"),
            job_r(C.ratio_pct(F.col("s_v2"), F.col("s_v1")), 1).alias("taux_pourboire")), "zone_depart"),
        "speed_analysis": order(of("speed_analysis").select(
            C.slot_label("k1", "k2", S.DAYS_SHORT).alias("creneau"), n.alias("nb_courses"),
            job_r(_avg("v1"), 2).alias("distance_moyenne"),
            job_r(_avg("v2") * F.lit(60.0), 1).alias("duree_moyenne_min"),
            job_r(_avg("v3"), 1).alias("vitesse_moyenne_mph"),
            job_r(F.col("lo_v3"), 1).alias("vitesse_min"), job_r(F.col("hi_v3"), 1).alias("vitesse_max")),
            "creneau"),
        "peak_revenue": order(of("peak_revenue").select(
            C.slot_label("k1", "k2", S.DAYS_LONG).alias("creneau"), n.alias("nb_courses"),
            job_r(_avg("v1"), 2).alias("fare_moy"), job_r(_avg("v2"), 2).alias("tip_moy"),
            job_r(C.ratio_pct(F.col("s_v2"), F.col("s_v1")), 1).alias("tip_rate"),
            job_r(F.col("s_v1"), 2).alias("recette_totale")), "creneau"),
        "payment_methods": order(of("payment_methods").select(
            C.payment_label(F.col("k1")).alias("mode_paiement"), n.alias("nb_courses"),
            _r(_avg("v1"), 2).alias("tarif_moyen"), _r(_avg("v2"), 2).alias("pourboire_moyen"),
            _r(_avg("v4") * F.lit(100.0), 1).alias("taux_pourboire_pct"),
            _r(F.col("s_v3"), 0).alias("recette_totale")),
            F.desc("nb_courses"), F.asc_nulls_last("mode_paiement")),
        "od_flows": order(of("od_flows").select(
            F.col("k1").alias("zone_depart"), F.col("k2").alias("zone_arrivee"), n.alias("nb_courses"),
            _r(_avg("v1"), 2).alias("dist_moy_miles"), _r(_avg("v2"), 2).alias("tarif_moy"),
            _r(_avg("v3"), 2).alias("pourboire_moy")), "zone_depart", "zone_arrivee"),
        "weekly_revenue": order(of("weekly_revenue").select(
            F.col("k2").alias("semaine"), F.col("k1").alias("annee"), n.alias("nb_courses"),
            _r(F.col("s_v1"), 0).alias("recette_totale"), _r(_avg("v1"), 2).alias("recette_moyenne"),
            _r(_avg("v2"), 2).alias("distance_moyenne"), _r(_avg("v3"), 2).alias("passagers_moyens")),
            "annee", "semaine"),
        "peak_vs_offpeak": order(of("peak_vs_offpeak").select(
            F.col("ks").alias("periode"), n.alias("nb_courses"),
            _r(_avg("v1"), 2).alias("recette_moy"), _r(_avg("v2"), 2).alias("pourboire_moy"),
            _r(F.col("s_v3"), 0).alias("recette_totale")),
            F.desc("recette_totale"), F.asc("periode")),
    }
    # Global counts: exactly one row even when no trip qualifies.
    for name, col in (("suspicious_trips", "courses_suspectes"), ("total_trips", "nb_lignes")):
        out[name] = of(name).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(col))
    out["od_flows_top20"] = out["od_flows"].orderBy(
        F.desc("nb_courses"), F.asc("zone_depart"), F.asc("zone_arrivee")).limit(20)
    return out


def shared_marts(trips: DataFrame, *, materialize: bool | str = False, sort: bool = True,
                 rounding: str = "sql", **params) -> dict[str, DataFrame]:
    """All marts from one pass.  ``materialize=True`` checkpoints the small
    aggregated groups into the session's checkpoint folder first (one job),
    so the marts can be written one by one without rescanning the trips;
    a path writes them there instead, for the caller to remove.
    Without it each mart is planned on its own (the optimizer prunes the
    shared aggregation to that mart's columns), i.e. one scan per mart; to
    get several results from one unmaterialized pass, combine them in one
    aggregation as ``kpi_summary_one_pass`` does."""
    groups = aggregate_entries(mart_entries(trips, rounding=rounding, **params))
    if isinstance(materialize, str):
        groups.write.mode("overwrite").parquet(materialize)
        groups = groups.sparkSession.read.schema(groups.schema).parquet(materialize)
    elif materialize:
        groups = groups.checkpoint(eager=True)
    return marts_from_groups(groups, sort=sort, rounding=rounding)


# ---------------------------------------------------------------------------
# The KPI summary from one scan
# ---------------------------------------------------------------------------
# grouping_id() of each grouping set over (wd, hr, zone, pay): a bit is 1
# for a column the set does not group by.
_GID_SLOT, _GID_HOUR, _GID_ZONE, _GID_PAY = 0b0011, 0b1011, 0b1101, 0b1110


def kpi_groups(trips: DataFrame, *, max_amount: float = S.MAX_AMOUNT,
               max_speed: float = S.MAX_SPEED_MPH, min_miles: float = S.SUSPICIOUS_MIN_MILES,
               max_seconds: int = S.SUSPICIOUS_MAX_SECONDS, rounding: str = "sql") -> DataFrame:
    """One scan, one aggregation with GROUPING SETS ((weekday, hour), (hour),
    (zone), (payment code)) and one conditional count or sum per mart: every
    group the KPI table needs, a few hundred rows in all.  Spark expands each
    trip once per set and aggregates map-side before the single exchange."""
    t = A.with_timing(trips)
    pu = F.col(S.PICKUP)
    secs, speed = F.col("duree_s"), F.col("vitesse_mph")
    flags = t.select(
        F.weekday(pu).alias("wd"), F.hour(pu).alias("hr"),
        F.col("PULocationID").alias("zone"), F.col("payment_type").alias("pay"),
        PR.has_pickup().alias("f_hour"),
        PR.zone_revenue_ok(max_amount).alias("f_zone"),
        PR.speed_ok(max_speed, seconds=secs, speed=speed).alias("f_speed"), speed.alias("speed"),
        PR.peak_revenue_ok(max_amount).alias("f_peak"), C.trip_cents("fare_amount", rounding).alias("fare2"),
        PR.payment_ok(max_amount).alias("f_pay"),
        PR.suspicious(min_miles, max_seconds).alias("f_susp"))
    return (flags.groupingSets([["wd", "hr"], ["hr"], ["zone"], ["pay"]], "wd", "hr", "zone", "pay")
            .agg(F.grouping_id().alias("gid"),
                 F.count(F.lit(1)).alias("n"),
                 F.count_if("f_hour").alias("n_hour"),
                 F.count_if("f_zone").alias("n_zone"),
                 F.count_if("f_speed").alias("n_speed"),
                 F.sum(F.when(F.col("f_speed"), F.col("speed"))).alias("s_speed"),
                 F.count_if("f_peak").alias("n_peak"),
                 F.sum(F.when(F.col("f_peak"), F.col("fare2"))).alias("s_fare2"),
                 F.count_if("f_pay").alias("n_pay"),
                 F.count_if("f_susp").alias("n_susp")))


def kpi_summary_one_pass(trips: DataFrame, *, rounding: str = "sql", **params) -> DataFrame:
    """``kpis.kpi_summary`` over the seven marts it reads, from one scan:
    ``kpi_groups``, then a single global aggregation of those groups with one
    conditional aggregate per indicator.  A mart's row exists where its
    conditional count is positive.  Arg-max picks are
    ``min(struct(-measure, key))``: the largest measure, ties to the smallest
    key, as the top-1 of each mart does."""
    from farebox.operators import kpis as K

    g = kpi_groups(trips, rounding=rounding, **params)
    job_r = C.rounder(rounding)
    gid = F.col("gid")

    def of(gid_value: int, count: str, expr: Column) -> Column:
        return F.when((gid == gid_value) & (F.col(count) > 0), expr)

    slot_revenue = job_r(F.col("s_fare2"), 2)
    slot_speed = job_r(F.col("s_speed") / F.col("n_speed"), 1)
    pay_label = C.payment_label(F.col("pay"))
    picked = g.agg(
        F.coalesce(F.sum(F.when(gid == _GID_SLOT, F.col("n"))), F.lit(0)).alias("lignes"),
        F.count(of(_GID_SLOT, "n_peak", F.lit(1))).alias("creneaux"),
        F.sum(of(_GID_SLOT, "n_peak", F.col("n_peak"))).alias("courses"),
        _r(F.sum(of(_GID_SLOT, "n_peak", slot_revenue)), 2).alias("recette"),
        F.min(of(_GID_SLOT, "n_peak", F.struct(
            -slot_revenue, C.slot_label("wd", "hr", S.DAYS_LONG).alias("v")))).alias("slot"),
        F.coalesce(F.sum(F.when(gid == _GID_SLOT, F.col("n_susp"))), F.lit(0)).alias("suspectes"),
        F.min(of(_GID_PAY, "n_pay", F.struct(-F.col("n_pay"), pay_label.isNull(), pay_label.alias("v"))))
        .alias("paiement"),
        F.min(of(_GID_ZONE, "n_zone", F.struct(-F.col("n_zone"), F.col("zone").cast("string").alias("v"))))
        .alias("zone"),
        F.avg(of(_GID_SLOT, "n_speed", slot_speed)).alias("vitesse"),
        F.min(of(_GID_HOUR, "n_hour", F.struct(-F.col("n_hour"), C.hour_label("hr").alias("v"))))
        .alias("heure"),
    )
    # (format_string renders NULL as text, hence the explicit guard)
    speed_text = F.when(F.col("vitesse").isNotNull(), F.concat(
        C.french_decimal(_r(C.mph_to_kmh(F.col("vitesse")), 1), 1), F.lit(" km/h ("),
        C.french_decimal(_r(F.col("vitesse"), 2), 2), F.lit(" mph)")))
    has_slots = F.col("creneaux") > 0
    rows = [
        (K.KPI_ROWS, F.col("lignes").cast("string")),
        (K.KPI_SLOTS, F.when(has_slots, F.col("creneaux").cast("string"))),
        (K.KPI_TRIPS, F.when(has_slots, F.format_number(F.col("courses"), 0))),
        (K.KPI_REVENUE, F.when(has_slots, F.format_number(F.col("recette"), 2))),
        (K.KPI_BEST_SLOT, F.col("slot.v")),
        (K.KPI_SUSPICIOUS, F.col("suspectes").cast("string")),
        (K.KPI_PAYMENT, F.col("paiement.v")),
        (K.KPI_ZONE, F.col("zone.v")),
        (K.KPI_SPEED, speed_text),
        (K.KPI_HOUR, F.concat(F.col("heure.v"), F.lit("h"))),
    ]
    # One row per indicator; an indicator of an empty mart is NULL and left
    # out (the payment label itself may be NULL: it is kept when the mart
    # has rows).
    entries = [F.struct(F.lit(label).alias("indicateur"), value.alias("valeur"),
                        (value.isNotNull() | (F.lit(label == K.KPI_PAYMENT) & F.col("paiement").isNotNull()))
                        .alias("present"))
               for label, value in rows]
    return (picked.select(F.inline(F.array(*entries)))
            .filter(F.col("present")).drop("present"))
