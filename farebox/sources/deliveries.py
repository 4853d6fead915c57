"""The ``events`` table as it would arrive: in deliveries, with late rows.

A row's delivery is fixed arithmetic on its time and id, so that the SQL
oracle can state which rows come too late."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the derivation (shared with the SQL oracle).
STEP_DAYS, LATE_EVERY = 10, 41

_DELIVERY = "livraison"


def with_delivery(events: DataFrame) -> DataFrame:
    """Ten days are a delivery; every 41st row comes one delivery later."""
    day = F.date_diff(F.to_date("ts"), F.to_date(F.lit("1970-01-01")))
    late = F.when(F.col("event_id") % LATE_EVERY == 0, 1).otherwise(0)
    return events.where("ts IS NOT NULL").withColumn(_DELIVERY, (F.floor(day / STEP_DAYS) + late).cast("long"))


def deliver(spark: SparkSession, sf_dir: str, landing: str) -> Iterator[int]:
    """Write one delivery after the other into the folder; each step of the
    iterator has landed one more.  The deliveries of a table are as many as its decades of days."""
    events = with_delivery(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))
    for r in events.select(_DELIVERY).distinct().orderBy(_DELIVERY).collect():
        events.where(F.col(_DELIVERY) == r[0]).drop(_DELIVERY).write.mode("append").parquet(landing)
        yield r[0]
