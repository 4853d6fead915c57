"""Marts from a user's own mapper and aggregate, in pandas.

The built-in marts are column expressions and need no Python.  For what cannot be
said that way a user gives an ``Aggregate`` of three functions over pandas
frames, and perhaps a mapper:

``partial``  rows of one key -> partial rows (in the tasks that read the trips)
``merge``    partial rows of one key -> fewer partial rows
``final``    partial rows of one key -> result rows

The functions get the columns without the key, and return them without the key.
A task keeps the partial rows of all its keys, merges them when there are many, and sends on
what is left: a key that holds a third of all trips leaves a task as its
merged partial rows, like any other.  These are merged again in ``salts``
groups a key before the final step, so no group has more rows than tasks / ``salts`` times a merged
part.  ``merge`` has to be associative and commutative, as results may come in any order and
tasks may run twice; what bounds memory is how small it makes a part."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Frames = Callable[[pd.DataFrame], pd.DataFrame]
HELD, SALTS = 200_000, 16        # partial rows that a task keeps before it merges; groups of a key before the final step


@dataclass(frozen=True)
class Aggregate:
    partial: Frames
    merge: Frames
    final: Frames
    partial_schema: str          # DDL of the partial rows, without the key
    result_schema: str           # DDL of the result rows, without the key


def _groups(frame: pd.DataFrame, keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Rows by key; NULL is a key."""
    for key, rows in frame.groupby(keys, dropna=False, sort=False):
        yield tuple(None if pd.isna(k) else k for k in key), rows.drop(columns=keys)


def _with_key(key: tuple, keys: list[str], rows: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    out = rows[names].copy()
    for i, (name, value) in enumerate(zip(keys, key)):
        out.insert(i, name, pd.Series([value] * len(out), index=out.index, dtype=object))
    return out


def _partial_step(keys: list[str], names: list[str], aggregate: Aggregate, held: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict[tuple, list[pd.DataFrame]] = {}
        n = 0

        def merged():
            return {k: aggregate.merge(pd.concat(p, ignore_index=True)) for k, p in parts.items()}
        for frame in frames:
            for key, rows in _groups(frame, keys):
                part = aggregate.partial(rows)
                parts.setdefault(key, []).append(part)
                n += len(part)
            if n > held:
                done = merged()
                n = sum(map(len, done.values()))
                parts = {k: [p] for k, p in done.items()}
                if 2 * n > held:              # many keys: they go on as they are
                    yield from (_with_key(k, keys, p, names) for k, p in done.items())
                    parts, n = {}, 0
        yield from (_with_key(k, keys, p, names) for k, p in merged().items())
    return run


def user_mart(trips: DataFrame, keys: Sequence[str], columns: Sequence[str], aggregate: Aggregate, *,
              mapper: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None, mapped: str | None = None,
              held: int = HELD, salts: int = SALTS) -> DataFrame:
    """One mart: the keys and the result rows of ``aggregate``.  ``mapper``
    turns frames of trips into frames of the DDL ``mapped`` first (rows in, any number of rows out);
    without it, only ``keys`` and ``columns`` of the trips are read."""
    keys, columns = list(keys), list(columns)
    rows = trips.mapInPandas(mapper, mapped) if mapper else trips
    rows = rows.select(*keys, *columns)
    key_fields = [T.StructField(k, rows.schema[k].dataType) for k in keys]
    partial = T.StructType.fromDDL(aggregate.partial_schema).fields
    names = [f.name for f in partial]
    part_schema = T.StructType([*key_fields, *partial])
    result = T.StructType.fromDDL(aggregate.result_schema).fields

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _with_key(key[:-1], keys, aggregate.merge(frame[names]), names)

    def final(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _with_key(key, keys, aggregate.final(aggregate.merge(frame[names])), [f.name for f in result])

    parts = rows.mapInPandas(_partial_step(keys, names, aggregate, held), part_schema)
    salted = parts.withColumn("_salt", F.spark_partition_id() % salts)
    merged = salted.groupBy(*keys, "_salt").applyInPandas(merge, part_schema)
    return merged.groupBy(*keys).applyInPandas(final, T.StructType([*key_fields, *result]))


# --- an aggregate that no built-in mart has: the exact median, from a histogram ------
def _counted(rows: pd.DataFrame) -> pd.DataFrame:
    n = rows["cents"].dropna().value_counts(sort=False)
    return pd.DataFrame({"cents": n.index.astype("int64"), "n": n.to_numpy("int64")})


def _summed(parts: pd.DataFrame) -> pd.DataFrame:
    return parts.groupby("cents", as_index=False, sort=False)["n"].sum()


def _median(parts: pd.DataFrame) -> pd.DataFrame:
    """The smaller middle value, and how many values there are."""
    ordered = parts.sort_values("cents")
    upto, total = ordered["n"].cumsum(), int(ordered["n"].sum())
    middle = ordered["cents"][upto >= (total + 1) // 2]
    return pd.DataFrame({"nb_courses": [total], "mediane": [int(middle.iloc[0]) / 100 if total else None]})


MEDIAN_OF_CENTS = Aggregate(_counted, _summed, _median, "cents long, n long", "nb_courses long, mediane double")


def median_fare(trips: DataFrame, key: str, *, max_amount: float) -> DataFrame:
    """Exact median fare by ``key``, to the cent, of fares above 0 and below
    ``max_amount``; a part holds a row per cent value at most."""
    fare = F.col("fare_amount")
    cents = F.round(F.round(fare, 2) * 100).cast("long")
    kept = trips.where((fare > 0) & (fare < max_amount)).select(key, cents.alias("cents"))
    return user_mart(kept, [key], ["cents"], MEDIAN_OF_CENTS)
