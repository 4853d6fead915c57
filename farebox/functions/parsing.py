"""Tolerant typing of text fields.  A field that does not parse becomes NULL
(never an error, never a dropped row), so each mart drops a record only for
the fields it reads.  All JVM-side: ``rlike`` + ``try_cast``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: the accepted text forms.
# Timestamp: "%Y-%m-%d %H:%M:%S" with 1- or 2-digit month/day/hour/minute/second.
TIMESTAMP_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
# Float: decimal or exponent notation with optional digit-group underscores,
# or nan / inf / infinity (any case), surrounding blanks allowed.
FLOAT_PATTERN = (
    r"(?i)^\s*[+-]?("
    r"((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([e][+-]?\d+(_\d+)*)?"
    r"|nan|inf|infinity)\s*$"
)
# Integer: optional sign and digits, surrounding blanks allowed.
INT_PATTERN = r"^\s*[+-]?\d+\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(s: Column | str) -> Column:
    """Naive (TIMESTAMP_NTZ) timestamp, NULL when the text is not a complete
    date-time or names an impossible date (2023-02-30)."""
    s = _c(s)
    return F.when(s.rlike(TIMESTAMP_PATTERN), s.try_cast("timestamp_ntz"))


def parse_double(s: Column | str) -> Column:
    """DOUBLE, NULL unless the text is a plain float literal ('nan' -> NaN)."""
    s = _c(s)
    return F.when(s.rlike(FLOAT_PATTERN), F.regexp_replace(s, "_", "").try_cast("double"))


def parse_int(s: Column | str) -> Column:
    """INT, NULL for anything but an integer literal ('1.0' -> NULL)."""
    s = _c(s)
    return F.when(s.rlike(INT_PATTERN), s.try_cast("int"))


def parse_key(s: Column | str) -> Column:
    """A text key without the blanks around it, NULL when nothing is left."""
    return F.nullif(F.trim(_c(s)), F.lit(""))


def coerce_numeric(df, columns):
    """Force the listed columns to DOUBLE, unparsable values to NULL
    (the report's numeric coercion of mart columns)."""
    out = df
    for c in columns:
        if c in df.columns:
            out = out.withColumn(c, _c(c).cast("string").try_cast("double"))
    return out
