"""ANSI-SQL statements equivalent to the registered queries, written for an
independent engine (DuckDB) over the benchmark tables.  They are the
correctness oracle: each starts from the same ``trips`` derivation of
``lineitem`` and spells out every filter, key and aggregate of the
DataFrame implementation, so any semantic slip shows up as a mismatch."""

from __future__ import annotations

from farebox import schema as S
from farebox.operators import weekly as WK
from farebox.plans import audit as AU
from farebox.sources import deliveries as DL
from farebox.sources import dirty as D
from farebox.sources import lineitem as L

PU = "tpep_pickup_datetime"
DO = "tpep_dropoff_datetime"

_SOD = f"((l_orderkey * {L.SOD_ORDER} + l_linenumber * {L.SOD_LINE} + l_partkey * {L.SOD_PART}) % {L.SECONDS_PER_DAY})"
_DUR = f"((l_partkey * {L.DUR_PART} + l_suppkey * {L.DUR_SUPP} + l_linenumber * {L.DUR_LINE}) % {L.DUR_SPAN} - {L.DUR_SHIFT})"

TRIPS = f"""trips AS (
  SELECT
    CAST((l_orderkey + l_linenumber) % 2 + 1 AS INTEGER) AS VendorID,
    CAST(l_shipdate AS TIMESTAMP) + to_seconds({_SOD}) AS {PU},
    CAST(l_shipdate AS TIMESTAMP) + to_seconds({_SOD} + {_DUR}) AS {DO},
    CAST(l_linenumber AS DOUBLE) AS passenger_count,
    l_quantity / 5 AS trip_distance,
    CAST(l_suppkey % {L.ZONES} + 1 AS INTEGER) AS PULocationID,
    CAST(l_partkey % {L.ZONES} + 1 AS INTEGER) AS DOLocationID,
    CAST((l_orderkey + l_linenumber) % {L.PAYMENT_CODES} AS INTEGER) AS payment_type,
    l_extendedprice / {L.FARE_DIVISOR} AS fare_amount,
    (l_extendedprice / {L.FARE_DIVISOR}) * (l_discount - 0.01) AS tip_amount,
    (l_extendedprice / {L.FARE_DIVISOR}) * (0.99 + l_discount + l_tax) AS total_amount
  FROM lineitem
)"""


def _days(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


HOUR = f"lpad(CAST(hour({PU}) AS VARCHAR), 2, '0')"
SHORT_SLOT = f"(({_days(S.DAYS_SHORT)})[isodow({PU})] || '-' || {HOUR})"
LONG_SLOT = f"(({_days(S.DAYS_LONG)})[isodow({PU})] || '-' || {HOUR})"
SECS = f"(CAST(date_diff('microsecond', {PU}, {DO}) AS DOUBLE) / 1000000.0)"
HOURS = f"({SECS} / 3600.0)"
SPEED = f"(trip_distance / {HOURS})"
PAYMENT_LABEL = (
    "CASE payment_type "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in S.PAYMENT_LABELS.items())
    + f" ELSE CONCAT('{S.PAYMENT_OTHER_PREFIX}', CAST(payment_type AS VARCHAR), '{S.PAYMENT_OTHER_SUFFIX}') END"
)
PERIOD = (
    f"CASE WHEN hour({PU}) BETWEEN {S.PERIOD_MORNING[1]} AND {S.PERIOD_MORNING[2]} THEN '{S.PERIOD_MORNING[0]}' "
    f"WHEN hour({PU}) BETWEEN {S.PERIOD_EVENING[1]} AND {S.PERIOD_EVENING[2]} THEN '{S.PERIOD_EVENING[0]}' "
    f"ELSE '{S.PERIOD_OFFPEAK}' END"
)
M = int(S.MAX_AMOUNT)

MARTS_SQL: dict[str, str] = {
    "trips_per_hour": f"""
SELECT {HOUR} AS heure, COUNT(*) AS nb_courses
FROM trips WHERE {PU} IS NOT NULL
GROUP BY 1""",
    "revenue_per_zone": f"""
SELECT CAST(PULocationID AS VARCHAR) AS zone_depart, COUNT(*) AS nb_courses,
  RND(AVG(fare_amount), 2) AS tarif_moyen,
  RND(AVG(tip_amount), 2) AS pourboire_moyen,
  RND(AVG(total_amount), 2) AS montant_moyen,
  RND(CASE WHEN SUM(fare_amount) > 0 THEN SUM(tip_amount) / SUM(fare_amount) * 100.0 ELSE 0.0 END, 1) AS taux_pourboire
FROM trips
WHERE PULocationID IS NOT NULL AND fare_amount > 0 AND fare_amount < {M} AND tip_amount >= 0
  AND total_amount > 0 AND total_amount < {M}
  AND NOT isnan(fare_amount) AND NOT isnan(tip_amount) AND NOT isnan(total_amount)
GROUP BY 1""",
    "speed_analysis": f"""
SELECT {SHORT_SLOT} AS creneau, COUNT(*) AS nb_courses,
  RND(AVG(trip_distance), 2) AS distance_moyenne,
  RND(AVG({HOURS}) * 60.0, 1) AS duree_moyenne_min,
  RND(AVG({SPEED}), 1) AS vitesse_moyenne_mph,
  RND(MIN({SPEED}), 1) AS vitesse_min,
  RND(MAX({SPEED}), 1) AS vitesse_max
FROM trips
WHERE trip_distance > 0 AND NOT isnan(trip_distance) AND {SECS} > 0
  AND {SPEED} > 0 AND {SPEED} < {int(S.MAX_SPEED_MPH)}
GROUP BY 1""",
    "peak_revenue": f"""
SELECT {LONG_SLOT} AS creneau, COUNT(*) AS nb_courses,
  RND(AVG(RND(fare_amount, 2)), 2) AS fare_moy,
  RND(AVG(RND(tip_amount, 2)), 2) AS tip_moy,
  RND(CASE WHEN SUM(RND(fare_amount, 2)) > 0
             THEN SUM(RND(tip_amount, 2)) / SUM(RND(fare_amount, 2)) * 100.0 ELSE 0.0 END, 1) AS tip_rate,
  RND(SUM(RND(fare_amount, 2)), 2) AS recette_totale
FROM trips
WHERE {PU} IS NOT NULL AND tip_amount IS NOT NULL AND fare_amount > 0
  AND total_amount > 0 AND total_amount < {M}
  AND NOT isnan(fare_amount) AND NOT isnan(total_amount)
GROUP BY 1""",
    "payment_methods": f"""
SELECT {PAYMENT_LABEL} AS mode_paiement, COUNT(*) AS nb_courses,
  RND(AVG(fare_amount), 2) AS tarif_moyen,
  RND(AVG(tip_amount), 2) AS pourboire_moyen,
  RND(AVG(tip_amount / NULLIF(fare_amount, 0)) * 100.0, 1) AS taux_pourboire_pct,
  RND(SUM(total_amount), 0) AS recette_totale
FROM trips
WHERE fare_amount > 0 AND fare_amount < {M} AND tip_amount >= 0
GROUP BY payment_type""",
    "od_flows": f"""
SELECT PULocationID AS zone_depart, DOLocationID AS zone_arrivee, COUNT(*) AS nb_courses,
  RND(AVG(trip_distance), 2) AS dist_moy_miles,
  RND(AVG(fare_amount), 2) AS tarif_moy,
  RND(AVG(tip_amount), 2) AS pourboire_moy
FROM trips
WHERE trip_distance > 0 AND fare_amount > 0 AND PULocationID != DOLocationID
GROUP BY PULocationID, DOLocationID""",
    "weekly_revenue": f"""
SELECT CAST(weekofyear(CAST({PU} AS DATE)) AS INTEGER) AS semaine,
  CAST(year(CAST({PU} AS DATE)) AS INTEGER) AS annee,
  COUNT(*) AS nb_courses,
  RND(SUM(total_amount), 0) AS recette_totale,
  RND(AVG(total_amount), 2) AS recette_moyenne,
  RND(AVG(trip_distance), 2) AS distance_moyenne,
  RND(AVG(passenger_count), 2) AS passagers_moyens
FROM trips
WHERE {PU} IS NOT NULL AND total_amount > 0 AND total_amount < {M}
  AND year(CAST({PU} AS DATE)) = {L.TEST_WEEKLY_YEAR}
GROUP BY 1, 2""",
    "suspicious_trips": f"""
SELECT COUNT(*) AS courses_suspectes
FROM trips
WHERE trip_distance > {int(S.SUSPICIOUS_MIN_MILES)} AND date_diff('second', {PU}, {DO}) < {S.SUSPICIOUS_MAX_SECONDS}""",
    "peak_vs_offpeak": f"""
SELECT periode, COUNT(*) AS nb_courses,
  RND(AVG(fare_amount), 2) AS recette_moy,
  RND(AVG(tip_amount), 2) AS pourboire_moy,
  RND(SUM(total_amount), 0) AS recette_totale
FROM (SELECT *, {PERIOD} AS periode FROM trips) v
WHERE fare_amount > 0 AND total_amount < {M}
GROUP BY periode""",
}


def expand_rnd(text: str) -> str:
    """Expand ``RND(x, n)`` into half-up rounding of the decimal value, snapped
    to 10 decimals first: the same rule as ``columns.round_half_up``."""
    out, i = [], 0
    while True:
        j = text.find("RND(", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        out.append(text[i:j])
        k, depth, comma = j + 4, 1, None
        while depth:
            ch = text[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = expand_rnd(text[j + 4:comma])
        digits = text[comma + 1:k - 1].strip()
        out.append(f"CAST(ROUND(CAST({inner} AS DECIMAL(38,10)), {digits}) AS DOUBLE)")
        i = k


MARTS_SQL = {name: expand_rnd(text) for name, text in MARTS_SQL.items()}


def with_marts(body: str, *marts: str) -> str:
    """``WITH trips AS (...), <mart> AS (...) <body>``."""
    ctes = [TRIPS] + [f"{m} AS ({MARTS_SQL[m]}\n)" for m in marts]
    return "WITH " + ",\n".join(ctes) + "\n" + expand_rnd(body.strip())


def mart_query(name: str, order_by: str | None = None, limit: int | None = None) -> str:
    tail = ""
    if order_by:
        tail += f" ORDER BY {order_by}"
    if limit is not None:
        tail += f" LIMIT {limit}"
    return with_marts(f"SELECT * FROM {name}{tail}", name)


def _kpi(label: str, value_sql: str, source: str, having: str = "") -> str:
    tail = f" HAVING {having}" if having else ""
    return f"SELECT '{label}' AS indicateur, CAST({value_sql} AS VARCHAR) AS valeur FROM {source}{tail}"


def _kpi_summary_sql() -> str:
    from farebox.operators import kpis as K
    km = S.MILES_TO_KM
    rows = [
        _kpi(K.KPI_ROWS, "COUNT(*)", "trips"),
        _kpi(K.KPI_SLOTS, "COUNT(*)", "peak_revenue", "COUNT(*) > 0"),
        _kpi(K.KPI_TRIPS, "format('{:,}', CAST(SUM(nb_courses) AS BIGINT))", "peak_revenue", "COUNT(*) > 0"),
        _kpi(K.KPI_REVENUE, "format('{:,.2f}', RND(SUM(recette_totale), 2))", "peak_revenue", "COUNT(*) > 0"),
        _kpi(K.KPI_BEST_SLOT, "creneau",
             "(SELECT creneau FROM peak_revenue ORDER BY recette_totale DESC NULLS LAST, creneau LIMIT 1) b"),
        _kpi(K.KPI_SUSPICIOUS, "courses_suspectes", "suspicious_trips"),
        _kpi(K.KPI_PAYMENT, "mode_paiement",
             "(SELECT mode_paiement FROM payment_methods ORDER BY nb_courses DESC NULLS LAST, "
             "mode_paiement NULLS LAST LIMIT 1) p"),
        _kpi(K.KPI_ZONE, "zone_depart",
             "(SELECT zone_depart FROM revenue_per_zone ORDER BY nb_courses DESC NULLS LAST, "
             "zone_depart LIMIT 1) z"),
        _kpi(K.KPI_SPEED,
             f"replace(printf('%.1f', RND(RND(AVG(vitesse_moyenne_mph) * {km}, 1), 1)), '.', ',') || ' km/h (' || "
             f"replace(printf('%.2f', RND(RND(AVG(vitesse_moyenne_mph), 2), 2)), '.', ',') || ' mph)'",
             "speed_analysis", "AVG(vitesse_moyenne_mph) IS NOT NULL"),
        _kpi(K.KPI_HOUR, "heure || 'h'",
             "(SELECT heure FROM trips_per_hour ORDER BY nb_courses DESC NULLS LAST, heure LIMIT 1) h"),
    ]
    return with_marts("\nUNION ALL\n".join(rows), "peak_revenue", "suspicious_trips",
                      "payment_methods", "revenue_per_zone", "speed_analysis", "trips_per_hour")


KPI_SUMMARY_SQL = _kpi_summary_sql()

KPI_DICT_SQL = f"""SELECT string_agg(indicateur || '=' || valeur, '; ' ORDER BY indicateur) AS kpis
FROM ({KPI_SUMMARY_SQL}) k"""
KPI_UNION_SQL = f"""SELECT * FROM ({KPI_SUMMARY_SQL}) k
UNION ALL
SELECT mode_paiement, CAST(nb_courses AS VARCHAR) FROM ({mart_query("payment_methods")}) p"""

# What a tolerant reader makes of the lines of ``farebox.sources.dirty``.
_CASE = f"(l_orderkey * {D.CASE_ORDER} + l_linenumber) % {D.CASES}"
_SHORT_NULL = f"cas = {D.SHORT}"
DIRTY_TRIPS = (TRIPS.replace("trips AS (", "clean AS (", 1).replace("SELECT", f"SELECT {_CASE} AS cas,", 1)
               + f""",
trips AS (
  SELECT * REPLACE (
    CASE WHEN cas IN ({D.PICKUP_TEXT}, {D.PICKUP_EMPTY}) THEN NULL ELSE {PU} END AS {PU},
    CASE cas WHEN {D.ZONE_EMPTY} THEN NULL WHEN {D.ZONE_TEXT} THEN 'abc'
      WHEN {D.ZONE_DECIMAL} THEN CAST(PULocationID AS VARCHAR) || '.0' ELSE CAST(PULocationID AS VARCHAR) END AS PULocationID,
    CASE WHEN {_SHORT_NULL} OR cas = {D.FARE_TEXT} THEN NULL WHEN cas = {D.FARE_NAN} THEN CAST('NaN' AS DOUBLE)
      ELSE fare_amount END AS fare_amount,
    CASE WHEN {_SHORT_NULL} OR cas IN ({D.TIP_EMPTY}, {D.TIP_TEXT}) THEN NULL ELSE tip_amount END AS tip_amount,
    CASE WHEN {_SHORT_NULL} THEN NULL WHEN cas = {D.TOTAL_NAN} THEN CAST('NaN' AS DOUBLE)
      ELSE total_amount END AS total_amount)
  FROM clean WHERE cas <> {D.HEADER}
)""")


def dirty_trips(numbers: bool = False) -> str:
    """``numbers``: with the odd number forms, as Python reads them."""
    return DIRTY_TRIPS.replace(f"CASE WHEN {_SHORT_NULL} OR cas = {D.FARE_TEXT} THEN NULL", f"""CASE WHEN cas = {D.GROUPED} THEN CAST(12.5 AS DOUBLE)
      WHEN cas IN ({D.SHORT}, {D.FARE_TEXT}, {D.SUFFIXED}) THEN NULL""") if numbers else DIRTY_TRIPS


def dirty_query(name: str, order_by: str, numbers: bool = False) -> str:
    """The mart over the dirty trips."""
    return f"WITH {dirty_trips(numbers)},\n{name} AS ({MARTS_SQL[name]}\n)\nSELECT * FROM {name} ORDER BY {order_by}"


# Hours of event time over deliveries (``farebox.sources.deliveries``): a row counts if its hour ends after the
# watermark of the deliveries before its own; an hour is closed if it ends by the last watermark.
_DELAY = "INTERVAL 2 HOUR"
_DELIVERED = f"""e AS (
  SELECT value, ts, date_trunc('hour', ts) AS debut, date_trunc('hour', ts) + INTERVAL 1 HOUR AS fin,
    date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) // {DL.STEP_DAYS}
      + CASE WHEN event_id % {DL.LATE_EVERY} = 0 THEN 1 ELSE 0 END AS d
  FROM events WHERE ts IS NOT NULL),
marks AS (
  SELECT d, lag(m) OVER (ORDER BY d) - {_DELAY} AS mark
  FROM (SELECT d, max(date_trunc('milliseconds', max(ts))) OVER (ORDER BY d) AS m FROM e GROUP BY d)),
final AS (SELECT date_trunc('milliseconds', max(ts)) - {_DELAY} AS last FROM e),
j AS (SELECT e.*, mark IS NULL OR fin > mark AS ok, fin <= last AS closed FROM e JOIN marks USING (d), final)"""
EVENTS_PER_HOUR_SQL = f"WITH {_DELIVERED}\n" + expand_rnd("""SELECT debut, fin, COUNT(*) AS nb_evenements,
  RND(SUM(value), 2) AS valeur_totale FROM j WHERE ok AND closed GROUP BY debut, fin""")
LATE_EVENTS_SQL = f"""WITH {_DELIVERED}
SELECT COUNT(*) AS recus, CAST(0 AS BIGINT) AS sans_heure, COUNT(*) FILTER (ok AND closed) AS comptes,
  COUNT(*) FILTER (NOT closed) AS ouverts, COUNT(*) FILTER (NOT ok AND closed) AS tardifs FROM j"""


# --- zone names ---------------------------------------------------------------
ZONES = f"""zones AS (
  SELECT CAST(s_suppkey * {L.ZONE_STEP} AS VARCHAR) AS cle, s_name AS nom, n_name AS quartier
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def with_zones(body: str, *marts: str) -> str:
    return with_marts(body, *marts).replace("WITH ", f"WITH {ZONES},\n", 1)


DISTRICT_SQL = with_zones(f"""SELECT quartier, COUNT(DISTINCT PULocationID) AS nb_zones, COUNT(*) AS nb_courses,
  RND(AVG(fare_amount), 2) AS tarif_moyen, RND(SUM(total_amount), 0) AS recette_totale,
  RND(CASE WHEN SUM(fare_amount) > 0 THEN SUM(tip_amount) / SUM(fare_amount) * 100.0 ELSE 0.0 END, 1) AS taux_pourboire
FROM trips LEFT JOIN zones ON CAST(PULocationID AS VARCHAR) = cle
WHERE fare_amount > 0 AND fare_amount < {M} AND tip_amount >= 0 AND total_amount > 0 AND total_amount < {M}
GROUP BY quartier""")


# --- weeks without gaps, unusual weeks -------------------------------------------
def _weeks(by: str = "") -> str:
    group, own = (f"{by}, ", f"g.{by}, ") if by else ("", "")
    same = f" AND t.{by} IS NOT DISTINCT FROM g.{by}" if by else ""
    return f"""totals AS (
  SELECT {group}CAST(date_trunc('week', {PU}) AS DATE) AS lundi, COUNT(*) AS nb_courses,
    COUNT(*) FILTER (trip_distance > {int(S.SUSPICIOUS_MIN_MILES)} AND date_diff('second', {PU}, {DO}) < {S.SUSPICIOUS_MAX_SECONDS})
      AS courses_suspectes, SUM(total_amount) AS total
  FROM trips WHERE {PU} IS NOT NULL GROUP BY ALL),
g AS (SELECT {group}CAST(unnest(generate_series(MIN(lundi), MAX(lundi), INTERVAL 7 DAY)) AS DATE) AS lundi FROM totals
      {"GROUP BY " + by if by else ""}),
weeks AS (
  SELECT {own}g.lundi, CAST(isoyear(g.lundi) AS INTEGER) AS annee_iso, CAST(weekofyear(g.lundi) AS INTEGER) AS semaine_iso,
    COALESCE(nb_courses, 0) AS nb_courses, COALESCE(courses_suspectes, 0) AS courses_suspectes,
    RND(COALESCE(total, 0.0), 0) AS recette_totale
  FROM g LEFT JOIN totals t ON t.lundi = g.lundi{same})"""


ISO_WEEKS_SQL = expand_rnd(f"WITH {TRIPS},\n{_weeks()}\nSELECT * FROM weeks ORDER BY lundi")


def weekly_anomalies_sql(by: str = "") -> str:
    group = f"{by}, " if by else ""
    frame = (f"({'PARTITION BY ' + by if by else ''} ORDER BY lundi "
             f"ROWS BETWEEN {WK.TRAILING} PRECEDING AND 1 PRECEDING)")
    return expand_rnd(f"""WITH {TRIPS},
{_weeks(by)},
w AS (
  SELECT *, COUNT(*) OVER {frame} AS n, CAST(SUM(nb_courses) OVER {frame} AS HUGEINT) AS s,
    CAST(SUM(nb_courses * nb_courses) OVER {frame} AS HUGEINT) AS q FROM weeks)
SELECT {group}lundi, annee_iso, semaine_iso, nb_courses, courses_suspectes,
  CASE WHEN n >= {WK.MIN_WEEKS} THEN RND(CAST(s AS DOUBLE) / n, 2) END AS moyenne_mobile,
  CASE WHEN n >= {WK.MIN_WEEKS} THEN RND(sqrt(CAST(n * q - s * s AS DOUBLE)) / n, 2) END AS ecart_type,
  CASE WHEN n >= {WK.MIN_WEEKS} THEN (n * nb_courses - s) * (n * nb_courses - s) > {WK.DEVIATIONS ** 2} * (n * q - s * s) END AS anomalie
FROM w ORDER BY {group}lundi""")


def reconciliation_sql() -> str:
    """Counts of the dirty lines by what is wrong with them, and of the trips in each mart."""
    zone = "CASE WHEN regexp_matches(PULocationID, '^[0-9]+$') THEN CAST(PULocationID AS INTEGER) END"
    marts = {name: text for name, text in MARTS_SQL.items() if name not in ("od_flows", "suspicious_trips")}
    accepted = {name: f"SELECT SUM(nb_courses) FROM {name}" for name in marts}
    accepted["od_flows"] = f"SELECT COUNT(*) FROM trips WHERE trip_distance > 0 AND fare_amount > 0 AND {zone} != DOLocationID"
    accepted["suspicious_trips"] = "SELECT courses_suspectes FROM suspicious_trips"
    accepted["total_trips"] = "SELECT COUNT(*) FROM trips"
    marts["suspicious_trips"] = MARTS_SQL["suspicious_trips"]
    bad = dict.fromkeys(AU.FIELDS, "FALSE") | {
        PU: f"cas = {D.PICKUP_TEXT}", "fare_amount": f"cas IN ({D.FARE_TEXT}, {D.SUFFIXED})", "tip_amount": f"cas = {D.TIP_TEXT}"}
    lines = {AU.READ: "TRUE", AU.HEADERS: f"cas = {D.HEADER}", AU.ODD_LENGTH: f"cas = {D.SHORT}"}
    lines |= {AU.UNREADABLE + n: c for n, c in bad.items()}
    rows = [f"SELECT '{n}' AS mesure, COUNT(*) FILTER ({c}) AS nb, CAST(NULL AS BIGINT) AS nb_mart, "
            "CAST(NULL AS BOOLEAN) AS concorde FROM clean" for n, c in lines.items()]
    rows += [f"SELECT '{AU.ACCEPTED}{n}', x, x, TRUE FROM (SELECT CAST(({q}) AS BIGINT) AS x)" for n, q in accepted.items()]
    ctes = ",\n".join([dirty_trips(numbers=True), *(f"{n} AS ({t}\n)" for n, t in marts.items())])
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(rows)


MEDIAN_FARES_SQL = with_marts(f"""SELECT {PAYMENT_LABEL} AS mode_paiement, COUNT(*) AS nb_courses,
  quantile_disc(CAST(ROUND(CAST(fare_amount AS DECIMAL(38,10)) , 2) * 100 AS BIGINT), 0.5) / 100 AS mediane
FROM trips WHERE fare_amount > 0 AND fare_amount < {M} GROUP BY payment_type""")
