"""Zone names (X1): marts joined with a lookup of zones.

The lookup has one row per zone: its number, its name and its district.  The marts
are joined after their aggregation, so a zone that holds a third of all trips
is one row of the join.  The lookup is broadcast only if it has been counted
and found small; a larger one is shuffled by zone, where adaptive execution splits a hot key
of row-level input.  Zones that the lookup does not have are kept, without a name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.functions import columns as C
from farebox.functions import predicates as PR

MAX_ROWS, MAX_BYTES = 100_000, 16 << 20        # of a lookup that is broadcast
ZONE_ID, NAME, DISTRICT = "LocationID", "Zone", "Borough"


def zone_lookup(zones: DataFrame) -> DataFrame:
    """One row per zone, with a text key as the marts have it; of a repeated zone the smallest name stays."""
    named = F.min(F.struct(F.col(NAME).alias("nom"), F.col(DISTRICT).alias("quartier"))).alias("z")
    return (zones.where(F.col(ZONE_ID).isNotNull()).groupBy(F.col(ZONE_ID).cast("string").alias("cle")).agg(named)
            .select("cle", "z.nom", "z.quartier"))


def is_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether a table has at most so many rows and bytes of text; at most one row more is read."""
    text = sum((F.coalesce(F.octet_length(F.col(n)), F.lit(0)) for n, t in df.dtypes if t == "string"), F.lit(0))
    some = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("b")).first()
    return some["n"] <= max_rows and some["b"] <= max_bytes


def with_zone_names(df: DataFrame, zones: DataFrame, column: str, prefix: str = "", *, max_rows: int = MAX_ROWS,
                    max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` (a mart or trips) with ``nom`` and ``quartier`` of the zone in ``column``; every row stays."""
    lookup = zone_lookup(zones)
    side = F.broadcast(lookup) if is_small(lookup, max_rows, max_bytes) else lookup.hint("merge")
    side = side.select(F.col("cle").alias("_cle"), F.col("nom").alias(f"{prefix}nom"), F.col("quartier").alias(f"{prefix}quartier"))
    return df.join(side, F.col(column).cast("string") == F.col("_cle"), "left").drop("_cle")


def revenue_per_district(trips: DataFrame, zones: DataFrame, *, max_amount: float = S.MAX_AMOUNT, sort: bool = True,
                         **limits) -> DataFrame:
    """The zone mart rolled up by district: trips are summed up by zone
    first, only these sums are joined and summed up again."""
    sums = (trips.filter(PR.zone_revenue_ok(max_amount)).groupBy(S.ZONE)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("fare_amount").alias("fare"), F.sum("tip_amount").alias("tip"),
                 F.sum("total_amount").alias("total")))
    n, fare, tip, total = F.sum("n"), F.sum("fare"), F.sum("tip"), F.sum("total")
    out = with_zone_names(sums, zones, S.ZONE, **limits).groupBy("quartier").agg(
        F.count(F.lit(1)).alias("nb_zones"), n.alias("nb_courses"), C.round_half_up(fare / n, 2).alias("tarif_moyen"),
        C.round_half_up(total, 0).alias("recette_totale"), C.round_half_up(C.ratio_pct(tip, fare), 1).alias("taux_pourboire"))
    return out.orderBy(F.asc_nulls_last("quartier")) if sort else out
