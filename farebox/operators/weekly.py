"""Weeks without gaps (X4) and unusual weeks.

Weeks are ISO weeks of ISO years, by their Monday, so the first days of
January belong to the week they are in (``weekly_revenue`` keeps the calendar year, as
its published form does).  A generated calendar from the first week to the
last is joined to the aggregated trips, so weeks without trips are rows
with zeros.  A week is unusual if its trips lie more than ``deviations`` standard
deviations from the mean of the weeks before it in the frame.

The trips are aggregated by week (and by ``by``) map-side; calendar, join and
window see a row per week and group only.  Without ``by`` the window is over one row per week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.functions import columns as C
from farebox.functions import predicates as PR

TRAILING, MIN_WEEKS, DEVIATIONS = 8, 4, 2


def weekly_totals(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trips, suspicious trips and total amount by Monday, for weeks that have trips."""
    return (trips.filter(PR.has_pickup()).groupBy(*by, F.to_date(F.date_trunc("WEEK", S.PICKUP)).alias("lundi"))
            .agg(F.count(F.lit(1)).alias("nb_courses"), F.count_if(PR.suspicious()).alias("courses_suspectes"),
                 F.sum("total_amount").alias("total")))


def gap_free_weeks(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every week between the first and the last of a group: ``lundi``,
    ``annee_iso``, ``semaine_iso``, ``nb_courses``, ``courses_suspectes``, ``recette_totale``."""
    span = totals.groupBy(*by).agg(F.min("lundi").alias("a"), F.max("lundi").alias("b")).where("a IS NOT NULL")
    calendar = span.select(*by, F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAYS"))).alias("lundi"))
    on = calendar["lundi"] == totals["lundi"]
    for c in by:
        on = on & calendar[c].eqNullSafe(totals[c])
    zero = F.lit(0).cast("long")
    return calendar.join(totals, on, "left").select(
        *[calendar[c] for c in by], calendar["lundi"],
        F.extract(F.lit("YEAROFWEEK"), calendar["lundi"]).cast("int").alias("annee_iso"),
        F.weekofyear(calendar["lundi"]).alias("semaine_iso"), F.coalesce("nb_courses", zero).alias("nb_courses"),
        F.coalesce("courses_suspectes", zero).alias("courses_suspectes"),
        C.round_half_up(F.coalesce("total", F.lit(0.0)), 0).alias("recette_totale"))


def iso_weeks(trips: DataFrame, *, sort: bool = True) -> DataFrame:
    out = gap_free_weeks(weekly_totals(trips))
    return out.orderBy("lundi") if sort else out


def weekly_anomalies(trips: DataFrame, by: Sequence[str] = (), *, trailing: int = TRAILING, min_weeks: int = MIN_WEEKS,
                     deviations: int = DEVIATIONS, sort: bool = True) -> DataFrame:
    """The gap-free weeks with ``moyenne_mobile`` and ``ecart_type`` of the
    ``trailing`` weeks before, and ``anomalie`` (NULL with fewer than ``min_weeks`` of them).
    The test is exact: (n x - sum)**2 > deviations**2 (n sum of squares - sum**2), in integers."""
    before = Window.partitionBy(*by).orderBy("lundi").rowsBetween(-trailing, -1)
    x = F.col("nb_courses").cast("decimal(18,0)")
    weeks = gap_free_weeks(weekly_totals(trips, by), by).withColumns({
        "n": F.count(F.lit(1)).over(before), "s": F.sum(x).over(before), "q": F.sum(x * x).over(before)})
    n, s = F.col("n").cast("decimal(5,0)"), F.col("s").cast("decimal(19,0)")
    spread = n * F.col("q").cast("decimal(33,0)") - s * s
    off = (n * x - s).cast("decimal(19,0)")
    known = F.col("n") >= min_weeks
    count = F.col("n").cast("double")
    out = weeks.select(
        *by, "lundi", "annee_iso", "semaine_iso", "nb_courses", "courses_suspectes",
        F.when(known, C.round_half_up(F.col("s").cast("double") / count, 2)).alias("moyenne_mobile"),
        F.when(known, C.round_half_up(F.sqrt(spread.cast("double")) / count, 2)).alias("ecart_type"),
        F.when(known, off * off > F.lit(deviations * deviations).cast("decimal(4,0)") * spread).alias("anomalie"))
    return out.orderBy(*by, "lundi") if sort else out
