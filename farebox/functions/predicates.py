"""Named row predicates of the marts.  Comparisons against NULL are NULL, so a
NULL field drops the row, as an unparsable field does in the reference jobs.

The jobs that compare in Python (``nan > 0`` is False) get an explicit NaN
guard, because in Spark ``NaN > 0`` is true.  The SQL-defined marts keep SQL
semantics (NaN sorts above every number there too)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.functions import columns as C


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_nan(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & ~F.isnan(_c(c))
    return cond


def has_pickup() -> Column:
    """F2 for the hour job: only the pickup must parse."""
    return F.col(S.PICKUP).isNotNull()


def zone_revenue_ok(max_amount: float = S.MAX_AMOUNT) -> Column:
    """zone present, 0 < fare < max, tip >= 0, 0 < total < max."""
    fare, tip, total = F.col("fare_amount"), F.col("tip_amount"), F.col("total_amount")
    return (F.col("PULocationID").isNotNull()
            & (fare > 0) & (fare < max_amount) & (tip >= 0)
            & (total > 0) & (total < max_amount)
            & not_nan("fare_amount", "tip_amount", "total_amount"))


def speed_ok(max_speed: float = S.MAX_SPEED_MPH, *, seconds: Column | None = None,
             speed: Column | None = None) -> Column:
    """F4 + F5: distance > 0, duration > 0, 0 < speed < max.  Pass the
    already-derived ``seconds`` / ``speed`` columns when a plan has them."""
    seconds = C.duration_seconds() if seconds is None else seconds
    speed = C.speed_mph() if speed is None else speed
    return ((F.col("trip_distance") > 0) & not_nan("trip_distance")
            & (seconds > 0) & (speed > 0) & (speed < max_speed))


def peak_revenue_ok(max_amount: float = S.MAX_AMOUNT) -> Column:
    """pickup parses, tip parses (any value, NaN included), fare > 0,
    0 < total < max."""
    fare, total = F.col("fare_amount"), F.col("total_amount")
    return (F.col(S.PICKUP).isNotNull() & F.col("tip_amount").isNotNull()
            & (fare > 0) & (total > 0) & (total < max_amount)
            & not_nan("fare_amount", "total_amount"))


def payment_ok(max_amount: float = S.MAX_AMOUNT) -> Column:
    """fare > 0, fare < max, tip >= 0; total unfiltered."""
    fare = F.col("fare_amount")
    return (fare > 0) & (fare < max_amount) & (F.col("tip_amount") >= 0)


def od_ok() -> Column:
    """F8: distance > 0, fare > 0, pickup zone differs from drop-off zone."""
    return ((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0)
            & (C.zone_number("PULocationID") != F.col("DOLocationID")))


def weekly_ok(year: int = S.WEEKLY_YEAR, max_amount: float = S.MAX_AMOUNT) -> Column:
    """pickup present, 0 < total < max, pickup in the calendar year."""
    total = F.col("total_amount")
    return (F.col(S.PICKUP).isNotNull() & (total > 0) & (total < max_amount)
            & C.in_calendar_year(S.PICKUP, year))


def suspicious(min_miles: float = S.SUSPICIOUS_MIN_MILES,
               max_seconds: int = S.SUSPICIOUS_MAX_SECONDS) -> Column:
    """distance > min and elapsed whole seconds < max (negative
    durations included)."""
    return (F.col("trip_distance") > min_miles) & (C.whole_seconds() < max_seconds)


def peak_offpeak_ok(max_amount: float = S.MAX_AMOUNT) -> Column:
    """fare > 0 and total < max (no lower bound on total)."""
    return (F.col("fare_amount") > 0) & (F.col("total_amount") < max_amount)


def not_header(first_field: str = "VendorID") -> Column:
    """drop stray header lines (the first field equals the marker)."""
    return ~F.col(first_field).eqNullSafe(F.lit(S.HEADER_MARKER))
