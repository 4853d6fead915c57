"""Derived-column expressions.  Every function returns a Catalyst ``Column``
built from ``pyspark.sql.functions`` so it stays inside whole-stage codegen;
none of them is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox import schema as S


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_label(hour: Column | str) -> Column:
    """Zero-padded hour number, ``8 -> '08'``."""
    return F.lpad(_c(hour).cast("string"), 2, "0")


def hour_key(ts: Column | str) -> Column:
    """Zero-padded pickup hour, ``'08'``."""
    return hour_label(F.hour(_c(ts)))


def day_label(weekday: Column | str, names: list[str]) -> Column:
    """Weekday name by Monday-first index (0 = Monday)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), _c(weekday) + 1)


def slot_label(weekday: Column | str, hour: Column | str, names: list[str]) -> Column:
    """``(3, 18) -> 'Jeu-18'`` / ``'JEUDI-18'``."""
    return F.concat(day_label(weekday, names), F.lit("-"), hour_label(hour))


def slot_key(ts: Column | str, names: list[str]) -> Column:
    """Weekday-hour slot of a timestamp, e.g. ``Jeu-18`` / ``JEUDI-18``."""
    return slot_label(F.weekday(_c(ts)), F.hour(_c(ts)), names)


def short_slot(ts: Column | str = S.PICKUP) -> Column:
    return slot_key(ts, S.DAYS_SHORT)


def long_slot(ts: Column | str = S.PICKUP) -> Column:
    return slot_key(ts, S.DAYS_LONG)


def elapsed(pickup: Column | str = S.PICKUP, dropoff: Column | str = S.DROPOFF) -> Column:
    """``dropoff - pickup`` as an INTERVAL SECOND.  Both columns are
    TIMESTAMP_NTZ, so the difference is plain wall-clock arithmetic: no time
    zone is involved and a DST change adds or removes no hour."""
    return (_c(dropoff) - _c(pickup)).cast("interval second")


def duration_seconds(pickup: Column | str = S.PICKUP,
                     dropoff: Column | str = S.DROPOFF) -> Column:
    """Exact elapsed seconds as DOUBLE (micro-second resolution)."""
    return elapsed(pickup, dropoff).cast("decimal(18,6)").cast("double")


def whole_seconds(pickup: Column | str = S.PICKUP,
                  dropoff: Column | str = S.DROPOFF) -> Column:
    """Elapsed whole seconds, the unit of the suspicious-trip rule."""
    return elapsed(pickup, dropoff).cast("bigint")


def duration_hours(pickup: Column | str = S.PICKUP,
                   dropoff: Column | str = S.DROPOFF) -> Column:
    return duration_seconds(pickup, dropoff) / F.lit(3600.0)


def speed_mph(distance: Column | str = "trip_distance",
              pickup: Column | str = S.PICKUP,
              dropoff: Column | str = S.DROPOFF) -> Column:
    """Distance over duration in hours; NULL for a zero duration (ANSI mode
    would raise on a division by zero).  Negative for negative durations:
    the speed filter removes those through its duration test."""
    return F.try_divide(_c(distance), duration_hours(pickup, dropoff))


def zone_number(zone: Column | str) -> Column:
    """INT zone of the origin-destination flows; text sources carry the
    departure zone as a text key, NULL here unless it is an integer."""
    return _c(zone).try_cast("int")


def payment_label(code: Column | str = "payment_type") -> Column:
    """Six named codes, ``Autre(<code>)`` otherwise, NULL for a NULL code."""
    code = _c(code)
    expr = None
    for k, label in S.PAYMENT_LABELS.items():
        expr = F.when(code == k, F.lit(label)) if expr is None else expr.when(code == k, F.lit(label))
    other = F.concat(F.lit(S.PAYMENT_OTHER_PREFIX), code.cast("string"), F.lit(S.PAYMENT_OTHER_SUFFIX))
    return expr.otherwise(other)


def period_label(ts: Column | str = S.PICKUP) -> Column:
    """Peak band of the pickup hour; a NULL pickup falls in off-peak."""
    h = F.hour(_c(ts))
    (m_name, m_lo, m_hi), (e_name, e_lo, e_hi) = S.PERIOD_MORNING, S.PERIOD_EVENING
    return (F.when(h.between(m_lo, m_hi), F.lit(m_name))
            .when(h.between(e_lo, e_hi), F.lit(e_name))
            .otherwise(F.lit(S.PERIOD_OFFPEAK)))


# Digits at which a computed value is snapped before the final rounding.
SNAP_DIGITS = 10


def round_half_up(c: Column | str, digits: int) -> Column:
    """Half-up rounding of the decimal value (the SQL ``ROUND`` rule).  The
    value is first snapped to ``SNAP_DIGITS`` decimals so that a sum or mean
    that is a tie in exact arithmetic (4.475 from cents) rounds the same way
    whatever order the partial sums were added in."""
    return F.round(F.round(_c(c), SNAP_DIGITS), digits)


def cents(c: Column | str) -> Column:
    """``ROUND(c, 2)``.  A value that is a whole number of cents already stays
    as it is, which spares it the decimal conversion of ``round``."""
    c = _c(c)
    return F.when(F.rint(c * F.lit(100.0)) / F.lit(100.0) == c, c).otherwise(F.round(c, 2))


def round_binary_half_even(c: Column | str, digits: int) -> Column:
    """Python's ``f"{x:.2f}"`` rule: the exact binary value of the double,
    rounded half-even (2.675 -> 2.67, 0.125 -> 0.12).  ``format_number``
    formats with java.text.DecimalFormat, which follows the same rule; the
    text is read back as a DOUBLE.  NaN and infinities pass through.  Meant
    for aggregated values (a string per value)."""
    c = _c(c)
    text = F.regexp_replace(F.format_number(c, digits), ",", "")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(text.try_cast("double"))


def trip_cents(c: Column | str, rounding: str) -> Column:
    """Per-trip rounding to cents of the slot revenue."""
    return cents(c) if rounding == "sql" else round_binary_half_even(c, 2)


ROUNDERS = {"sql": round_half_up, "python": round_binary_half_even}


def rounder(name: str):
    """The rounding function for a mart's ``rounding`` parameter."""
    if name not in ROUNDERS:
        raise ValueError(f"rounding must be one of {sorted(ROUNDERS)}, not {name!r}")
    return ROUNDERS[name]


def mph_to_kmh(c: Column | str) -> Column:
    return _c(c) * F.lit(S.MILES_TO_KM)


def ratio_pct(num: Column, den: Column) -> Column:
    """``num / den * 100`` or 0 when ``den`` is not positive (guarded
    division of the map/reduce reducers)."""
    return F.when(den > 0, num / den * F.lit(100.0)).otherwise(F.lit(0.0))


def year_start(year: int) -> Column:
    return F.make_timestamp_ntz(F.lit(year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def in_calendar_year(ts: Column | str, year: int) -> Column:
    """``YEAR(TO_DATE(ts)) = year`` written as a half-open range on the raw
    timestamp column, so the Parquet reader can skip row groups by min/max."""
    ts = _c(ts)
    return (ts >= year_start(year)) & (ts < year_start(year + 1))


def french_decimal(c: Column, digits: int) -> Column:
    """``22.3`` -> ``'22,3'`` after rounding (text KPI values)."""
    return F.translate(F.format_string(f"%.{digits}f", round_half_up(c, digits)), ".", ",")


def report_date() -> Column:
    """Generation date of a report, ``dd/MM/yyyy HH:mm``."""
    return F.date_format(F.current_timestamp(), "dd/MM/yyyy HH:mm")
