"""Schemas of the trip fact table and of the marts, plus the fixed values
(labels, day names, thresholds) the results must agree on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fact table: 19 columns in source order.  Text sources are read with every
# column as a string and typed afterwards (see farebox.sources.text), so a bad
# field only removes the row from the marts that read that field.
# ---------------------------------------------------------------------------
TRIP_COLUMNS: list[tuple[str, T.DataType]] = [
    ("VendorID", T.IntegerType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("RatecodeID", T.IntegerType()),
    ("store_and_fwd_flag", T.StringType()),
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("payment_type", T.IntegerType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
]

TRIP_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in TRIP_COLUMNS])

# All-string schema used to read delimited text before typing it.
RAW_TRIP_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n, _ in TRIP_COLUMNS]
)

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
ZONE = "PULocationID"

# ---------------------------------------------------------------------------
# Fixed values.  These must stay exactly as written: the marts' keys and
# labels are compared against published results.
# ---------------------------------------------------------------------------

# Weekday names, Monday first (short form: speed mart, long form: revenue mart).
DAYS_SHORT = ["Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim"]
DAYS_LONG = ["LUNDI", "MARDI", "MERCREDI", "JEUDI", "VENDREDI", "SAMEDI", "DIMANCHE"]

# Payment code -> label; any other code becomes "Autre(<code>)".
PAYMENT_LABELS = {
    1: "Carte_credit",
    2: "Cash",
    3: "Pas_charge",
    4: "Litige",
    5: "Inconnu",
    6: "Annule",
}
PAYMENT_OTHER_PREFIX = "Autre("
PAYMENT_OTHER_SUFFIX = ")"

# Period bands on the pickup hour (inclusive), everything else off-peak.
PERIOD_MORNING = ("POINTE_MATIN", 7, 9)
PERIOD_EVENING = ("POINTE_SOIR", 16, 19)
PERIOD_OFFPEAK = "HEURE_CREUSE"

# Thresholds (defaults of the keyword parameters of the marts).
MAX_AMOUNT = 500.0          # open upper bound on fare and total
MAX_SPEED_MPH = 120.0       # open upper bound on speed
SUSPICIOUS_MIN_MILES = 1.0  # distance strictly above
SUSPICIOUS_MAX_SECONDS = 60  # duration strictly below
WEEKLY_YEAR = 2023

MILES_TO_KM = 1.609344

# The header marker: a raw record whose first field is this is a header line.
HEADER_MARKER = "VendorID"

# ---------------------------------------------------------------------------
# Mart schemas (column order as emitted).
# ---------------------------------------------------------------------------
MART_SCHEMAS: dict[str, T.StructType] = {
    "trips_per_hour": T.StructType([
        T.StructField("heure", T.StringType()),
        T.StructField("nb_courses", T.LongType()),
    ]),
    "revenue_per_zone": T.StructType([
        T.StructField("zone_depart", T.StringType()),
        T.StructField("nb_courses", T.LongType()),
        T.StructField("tarif_moyen", T.DoubleType()),
        T.StructField("pourboire_moyen", T.DoubleType()),
        T.StructField("montant_moyen", T.DoubleType()),
        T.StructField("taux_pourboire", T.DoubleType()),
    ]),
    "speed_analysis": T.StructType([
        T.StructField("creneau", T.StringType()),
        T.StructField("nb_courses", T.LongType()),
        T.StructField("distance_moyenne", T.DoubleType()),
        T.StructField("duree_moyenne_min", T.DoubleType()),
        T.StructField("vitesse_moyenne_mph", T.DoubleType()),
        T.StructField("vitesse_min", T.DoubleType()),
        T.StructField("vitesse_max", T.DoubleType()),
    ]),
    "peak_revenue": T.StructType([
        T.StructField("creneau", T.StringType()),
        T.StructField("nb_courses", T.LongType()),
        T.StructField("fare_moy", T.DoubleType()),
        T.StructField("tip_moy", T.DoubleType()),
        T.StructField("tip_rate", T.DoubleType()),
        T.StructField("recette_totale", T.DoubleType()),
    ]),
    "payment_methods": T.StructType([
        T.StructField("mode_paiement", T.StringType()),
        T.StructField("nb_courses", T.LongType()),
        T.StructField("tarif_moyen", T.DoubleType()),
        T.StructField("pourboire_moyen", T.DoubleType()),
        T.StructField("taux_pourboire_pct", T.DoubleType()),
        T.StructField("recette_totale", T.DoubleType()),
    ]),
    "od_flows": T.StructType([
        T.StructField("zone_depart", T.IntegerType()),
        T.StructField("zone_arrivee", T.IntegerType()),
        T.StructField("nb_courses", T.LongType()),
        T.StructField("dist_moy_miles", T.DoubleType()),
        T.StructField("tarif_moy", T.DoubleType()),
        T.StructField("pourboire_moy", T.DoubleType()),
    ]),
    "weekly_revenue": T.StructType([
        T.StructField("semaine", T.IntegerType()),
        T.StructField("annee", T.IntegerType()),
        T.StructField("nb_courses", T.LongType()),
        T.StructField("recette_totale", T.DoubleType()),
        T.StructField("recette_moyenne", T.DoubleType()),
        T.StructField("distance_moyenne", T.DoubleType()),
        T.StructField("passagers_moyens", T.DoubleType()),
    ]),
    "suspicious_trips": T.StructType([
        T.StructField("courses_suspectes", T.LongType()),
    ]),
    "peak_vs_offpeak": T.StructType([
        T.StructField("periode", T.StringType()),
        T.StructField("nb_courses", T.LongType()),
        T.StructField("recette_moy", T.DoubleType()),
        T.StructField("pourboire_moy", T.DoubleType()),
        T.StructField("recette_totale", T.DoubleType()),
    ]),
    "kpi_summary": T.StructType([
        T.StructField("indicateur", T.StringType()),
        T.StructField("valeur", T.StringType()),
    ]),
}

# Decimals of each DOUBLE column as the text output prints it (the digits the
# mart rounds to).
MART_DECIMALS: dict[str, dict[str, int]] = {
    "revenue_per_zone": {"tarif_moyen": 2, "pourboire_moyen": 2, "montant_moyen": 2, "taux_pourboire": 1},
    "speed_analysis": {"distance_moyenne": 2, "duree_moyenne_min": 1, "vitesse_moyenne_mph": 1,
                       "vitesse_min": 1, "vitesse_max": 1},
    "peak_revenue": {"fare_moy": 2, "tip_moy": 2, "tip_rate": 1, "recette_totale": 2},
    "payment_methods": {"tarif_moyen": 2, "pourboire_moyen": 2, "taux_pourboire_pct": 1, "recette_totale": 0},
    "od_flows": {"dist_moy_miles": 2, "tarif_moy": 2, "pourboire_moy": 2},
    "weekly_revenue": {"recette_totale": 0, "recette_moyenne": 2, "distance_moyenne": 2, "passagers_moyens": 2},
    "peak_vs_offpeak": {"recette_moy": 2, "pourboire_moy": 2, "recette_totale": 0},
}

# Order of the marts that are sorted by a measure: column and whether it descends; NULLs stand last.
MART_ORDER: dict[str, list[tuple[str, bool]]] = {
    "payment_methods": [("nb_courses", True), ("mode_paiement", False)],
    "peak_vs_offpeak": [("recette_totale", True), ("periode", False)],
    "od_flows": [("nb_courses", True), ("zone_depart", False), ("zone_arrivee", False)],
}

# Key column(s) of each mart: the order of a written mart (one sorted output).
MART_KEYS: dict[str, list[str]] = {
    "trips_per_hour": ["heure"],
    "revenue_per_zone": ["zone_depart"],
    "speed_analysis": ["creneau"],
    "peak_revenue": ["creneau"],
    "payment_methods": ["mode_paiement"],
    "od_flows": ["zone_depart", "zone_arrivee"],
    "weekly_revenue": ["annee", "semaine"],
    "suspicious_trips": [],
    "peak_vs_offpeak": ["periode"],
    "kpi_summary": [],
}
