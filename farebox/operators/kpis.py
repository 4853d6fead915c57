"""Operators over marts: totals, shares, top-k, arg-max and the KPI summary
(A11-A14, K5-K19, P11-P14, U1).

Inputs are marts (a few hundred rows at most for every mart but the OD
flows), so these are cheap; they are still written as distributed plans:
top-k is ``orderBy + limit`` (TakeOrderedAndProject: per-partition top-k then
one bounded merge), a share divides by a one-row scalar subquery, never by an
unpartitioned window, and nothing is collected to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.functions import columns as C

# Fixed KPI labels (indicateur column of the summary).
KPI_ROWS = "Nombre de lignes"
KPI_SLOTS = "Nombre de créneaux"
KPI_TRIPS = "Nombre total de courses"
KPI_REVENUE = "Recette totale"
KPI_BEST_SLOT = "Créneau le plus rentable"
KPI_SUSPICIOUS = "Courses suspectes Hive"
KPI_PAYMENT = "Moyen de paiement dominant"
KPI_ZONE = "Zone de départ principale"
KPI_SPEED = "Vitesse moyenne observée"
KPI_HOUR = "Heure la plus chargée"
KPI_ORDER = [KPI_ROWS, KPI_SLOTS, KPI_TRIPS, KPI_REVENUE, KPI_BEST_SLOT, KPI_SUSPICIOUS, KPI_PAYMENT, KPI_ZONE, KPI_SPEED, KPI_HOUR]
FASTEST = "plus_fluide"
SLOWEST = "plus_congestionne"


# --------------------------------------------------------------------------
# K15 / K16 / K17 - generic ordered top-n
# --------------------------------------------------------------------------
def top_n(df: DataFrame, by: str | Column, n: int | None, *, ascending: bool = False,
          tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Rows ordered by ``by`` (descending by default) then the tie-break
    columns, first ``n`` (all when ``n`` is None)."""
    key = F.col(by) if isinstance(by, str) else by
    order = [key.asc_nulls_last() if ascending else key.desc_nulls_last()]
    order += [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tiebreak]
    out = df.orderBy(*order)
    return out.limit(n) if n is not None else out


def preview(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows of a mart in its key order (made explicit)."""
    return df.orderBy(*key).limit(n)


# --------------------------------------------------------------------------
# A11 - report totals over the revenue-per-slot mart
# --------------------------------------------------------------------------
def report_totals(peak: DataFrame) -> DataFrame:
    return peak.agg(F.count(F.lit(1)).alias("nb_creneaux"),
                    F.sum("nb_courses").alias("nb_courses"),
                    C.round_half_up(F.sum("recette_totale"), 2).alias("recette_totale"))


# K5 / K6 / K12 - most profitable slots
def top_revenue_slots(peak: DataFrame, n: int = 10) -> DataFrame:
    return top_n(peak, "recette_totale", n, tiebreak=["creneau"])


def top5_slots(peak: DataFrame) -> DataFrame:
    return top_revenue_slots(peak, 5)


def best_slot(peak: DataFrame) -> DataFrame:
    return top_revenue_slots(peak, 1)


# K7 - dominant payment method (arg-max of trips)
def dominant_payment(payment: DataFrame) -> DataFrame:
    return top_n(payment, "nb_courses", 1, tiebreak=["mode_paiement"]) \
        .select("mode_paiement", "nb_courses")


# A12 - share of trips per payment label, per cent to one decimal
def payment_share(payment: DataFrame) -> DataFrame:
    total = payment.agg(F.sum("nb_courses")).scalar()
    return payment.select(
        "mode_paiement", "nb_courses",
        C.round_half_up(F.col("nb_courses") / total * F.lit(100.0), 1).alias("part_pct"))


# K8 / K13 - busiest departure zones
def top_zones(zones: DataFrame, n: int = 10) -> DataFrame:
    return top_n(zones, "nb_courses", n, tiebreak=["zone_depart"])


# K11 - fastest slots
def top_speed_slots(speed: DataFrame, n: int = 15) -> DataFrame:
    return top_n(speed, "vitesse_moyenne_mph", n, tiebreak=["creneau"])


# K9 - most fluid and most congested slot, with km/h (P13).  One aggregate
# over the mart: the minimum of (-speed, slot) is the fastest slot (ties to
# the first slot name), the minimum of (speed, slot) the slowest.
def fastest_slowest_slot(speed: DataFrame) -> DataFrame:
    v, c = F.col("vitesse_moyenne_mph"), F.col("creneau")
    picked = speed.agg(
        F.min(F.struct((-v).alias("k"), c.alias("creneau"), v.alias("v"))).alias("f"),
        F.min(F.struct(v.alias("k"), c.alias("creneau"), v.alias("v"))).alias("s"))

    def row(label: str, side: str) -> Column:
        return F.struct(F.lit(label).alias("indicateur"),
                        F.col(f"{side}.creneau").alias("creneau"),
                        F.col(f"{side}.v").alias("vitesse_moyenne_mph"),
                        C.round_half_up(C.mph_to_kmh(F.col(f"{side}.v")), 1).alias("vitesse_moyenne_kmh"))
    return (picked.filter(F.col("f").isNotNull())
            .select(F.inline(F.array(row(FASTEST, "f"), row(SLOWEST, "s")))))


# K10 - busiest pickup hour
def busiest_hour(hours: DataFrame) -> DataFrame:
    return top_n(hours, "nb_courses", 1, tiebreak=["heure"])


# A13 - mean speed KPI: unweighted mean of slot means (the published figure)
# and the trip-weighted mean beside it.
def mean_speed_kpi(speed: DataFrame) -> DataFrame:
    v, n = F.col("vitesse_moyenne_mph"), F.col("nb_courses")
    mean = F.avg(v)
    return speed.agg(
        C.round_half_up(mean, 2).alias("vitesse_moyenne_mph"),
        C.round_half_up(C.mph_to_kmh(mean), 1).alias("vitesse_moyenne_kmh"),
        C.round_half_up(F.sum(v * n) / F.sum(n), 2).alias("vitesse_ponderee_mph"))


# K19 - calendar order of slots (Monday 00h first) as an explicit rank
def slot_calendar_rank(creneau: Column | str, names: list[str] = S.DAYS_SHORT) -> Column:
    c = F.col(creneau) if isinstance(creneau, str) else creneau
    day = F.array_position(F.array(*[F.lit(d) for d in names]), F.split(c, "-").getItem(0))
    hour = F.split(c, "-").getItem(1).cast("int")
    return ((day - 1) * 24 + hour).cast("int")


def calendar_order(speed: DataFrame, names: list[str] = S.DAYS_SHORT) -> DataFrame:
    return (speed.withColumn("ordre", slot_calendar_rank("creneau", names))
            .orderBy("ordre"))


# K14 - weekly series for the line chart
def weekly_series(weekly: DataFrame) -> DataFrame:
    return weekly.select("annee", "semaine", "nb_courses", "recette_totale") \
        .orderBy("annee", "semaine")


# --------------------------------------------------------------------------
# P11 / P14 / U1 / A14 - the KPI summary: one text row per indicator
# --------------------------------------------------------------------------
def kpi_row(label: str, value: Column) -> list[Column]:
    return [F.lit(label).alias("indicateur"), value.cast("string").alias("valeur")]


def kpi_summary(*, total: DataFrame | None = None, peak: DataFrame | None = None,
                suspicious: DataFrame | None = None, payment: DataFrame | None = None,
                zones: DataFrame | None = None, speed: DataFrame | None = None,
                hours: DataFrame | None = None) -> DataFrame:
    """Union of whichever indicators the given marts allow; a missing mart
    simply contributes no row (the emptiness guard)."""
    parts: list[DataFrame] = []
    if total is not None:
        parts.append(total.select(*kpi_row(KPI_ROWS, F.col("nb_lignes"))))
    if peak is not None:
        # an empty mart contributes no row (no "0 slots", no NULL revenue)
        t = report_totals(peak).filter(F.col("nb_creneaux") > 0)
        parts.append(t.select(*kpi_row(KPI_SLOTS, F.col("nb_creneaux"))))
        parts.append(t.select(*kpi_row(KPI_TRIPS, F.format_number(F.col("nb_courses"), 0))))
        parts.append(t.select(*kpi_row(KPI_REVENUE, F.format_number(F.col("recette_totale"), 2))))
        parts.append(best_slot(peak).select(*kpi_row(KPI_BEST_SLOT, F.col("creneau"))))
    if suspicious is not None:
        parts.append(suspicious.select(*kpi_row(KPI_SUSPICIOUS, F.col("courses_suspectes"))))
    if payment is not None:
        parts.append(dominant_payment(payment).select(*kpi_row(KPI_PAYMENT, F.col("mode_paiement"))))
    if zones is not None:
        parts.append(top_zones(zones, 1).select(*kpi_row(KPI_ZONE, F.col("zone_depart"))))
    if speed is not None:
        m = mean_speed_kpi(speed).filter(F.col("vitesse_moyenne_mph").isNotNull())
        text = F.concat(C.french_decimal(F.col("vitesse_moyenne_kmh"), 1), F.lit(" km/h ("),
                        C.french_decimal(F.col("vitesse_moyenne_mph"), 2), F.lit(" mph)"))
        parts.append(m.select(*kpi_row(KPI_SPEED, text)))
    if hours is not None:
        parts.append(busiest_hour(hours).select(*kpi_row(KPI_HOUR, F.concat(F.col("heure"), F.lit("h")))))
    if not parts:
        raise ValueError("kpi_summary needs at least one mart")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def append_kpis(kpis: DataFrame, extra: DataFrame) -> DataFrame:
    """KPI rows followed by extra rows (an empty left side is fine)."""
    return kpis.unionByName(extra)


# P12 - the two-column KPI table as one map value
def kpi_dict(kpis: DataFrame, position: str | None = None) -> DataFrame:
    """One map; of rows that repeat an indicator the last counts.  The order of
    rows is that of the column ``position``, or else the order as read."""
    at = F.col(position) if position else F.monotonically_increasing_id()
    rows = kpis.select("indicateur", "valeur", at.alias("_at")).groupBy("indicateur").agg(
        F.max_by("valeur", "_at").alias("valeur"), F.min("_at").alias("_at"))
    ordered = F.array_sort(F.collect_list(F.struct("_at", "indicateur", "valeur")))
    return rows.agg(F.map_from_entries(F.transform(
        ordered, lambda r: F.struct(r["indicateur"], r["valeur"]))).alias("kpis"))


# A11 + K5 + K6 over a revenue-per-slot mart (e.g. read back from its TSV):
# the slot report as three small DataFrames.
def slot_report(peak: DataFrame) -> dict[str, DataFrame]:
    return {"totals": report_totals(peak), "top5": top5_slots(peak), "best": best_slot(peak)}
