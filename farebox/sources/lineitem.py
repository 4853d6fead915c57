"""Trips derived from the benchmark ``lineitem`` table.

The benchmark tables hold no trip records, so every registered query reads a
``trips`` DataFrame computed from ``lineitem`` with plain arithmetic (the same
expressions are written in SQL for the oracle, see ``farebox.plans.sql``).
The derivation is a narrow projection: no shuffle, and it scales with
``lineitem``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the derivation (shared with the SQL oracle).
SOD_ORDER, SOD_LINE, SOD_PART, SECONDS_PER_DAY = 7919, 3607, 31, 86400
DUR_PART, DUR_SUPP, DUR_LINE, DUR_SPAN, DUR_SHIFT = 13, 7, 101, 3600, 60
ZONES = 40
PAYMENT_CODES = 7
FARE_DIVISOR = 199
TEST_WEEKLY_YEAR = 1998  # ship dates run 1995-2001

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def trip_columns() -> list[Column]:
    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"),
                      F.col("l_suppkey"), F.col("l_linenumber"))
    sod = (ok * SOD_ORDER + ln * SOD_LINE + pk * SOD_PART) % SECONDS_PER_DAY
    dur = (pk * DUR_PART + sk * DUR_SUPP + ln * DUR_LINE) % DUR_SPAN - DUR_SHIFT
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    fare = F.col("l_extendedprice") / F.lit(FARE_DIVISOR)
    return [
        ((ok + ln) % 2 + 1).cast("int").alias("VendorID"),
        F.timestamp_add("SECOND", sod, ship).alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", sod + dur, ship).alias("tpep_dropoff_datetime"),
        ln.cast("double").alias("passenger_count"),
        (F.col("l_quantity") / F.lit(5)).alias("trip_distance"),
        (sk % ZONES + 1).cast("int").alias("PULocationID"),
        (pk % ZONES + 1).cast("int").alias("DOLocationID"),
        ((ok + ln) % PAYMENT_CODES).cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        (fare * (F.col("l_discount") - F.lit(0.01))).alias("tip_amount"),
        (fare * (F.lit(0.99) + F.col("l_discount") + F.col("l_tax"))).alias("total_amount"),
    ]


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(*trip_columns())


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``trips`` view over ``{sf_dir}/lineitem.parquet``."""
    return trips_from_lineitem(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))


# Zones of the lookup: every second zone number has a supplier's name and its nation.
ZONE_STEP = 2


def load_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone lookup from ``supplier`` and ``nation``: LocationID, Zone, Borough."""
    base = sf_dir.rstrip("/")
    nation = spark.read.parquet(f"{base}/nation.parquet").select("n_nationkey", "n_name")
    supplier = spark.read.parquet(f"{base}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        (F.col("s_suppkey") * ZONE_STEP).alias("LocationID"), F.col("s_name").alias("Zone"), F.col("n_name").alias("Borough"))
