"""Marts kept up to date in batch: only new files are read.

The groups of ``plans.shared`` (counts, sums, minima and maxima per mart and
key) can be merged, so they are stored together with a manifest of the files they
come from.  A build lists the input, reads the files that the manifest does not have,
aggregates them in one pass, merges their groups with the stored ones and publishes
groups and manifest as one version (``sinks.publish``): a build that fails
changes nothing, and a file counts once.

Sums cannot be taken back: if a known file has changed or gone, or the marts'
parameters have, the build starts anew from all files.  The cost of a build grows with the new files;
the groups are as many as the marts have keys."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.plans import shared as SH
from farebox.sinks import publish as PB
from farebox.sources import text as TX

_FILE = ["path", "length", "modificationTime"]
_KEYS = ["m", "k1", "k2", "ks"]


@dataclass(frozen=True)
class Built:
    """What a build did: ``marts``, the number of files it read, and whether it started anew."""

    marts: dict[str, DataFrame]
    files_read: int
    anew: bool


def merge_groups(groups: DataFrame) -> DataFrame:
    """Groups of the same mart and key as one."""
    rest = [c for c in groups.columns if c not in _KEYS]
    of = {"lo": F.min, "hi": F.max}
    return groups.groupBy(*_KEYS).agg(*[of.get(c.split("_")[0], F.sum)(c).alias(c) for c in rest])


def _listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files of a folder; none is opened."""
    return spark.read.format("binaryFile").load(path).select(*_FILE)


def _read(spark: SparkSession, files: list[str], fmt: str, options: dict) -> DataFrame:
    if fmt == "csv":
        return TX.read_trips_text(spark, files, **options)
    if fmt == "parquet":
        return TX.read_trips_parquet(spark, files)
    raise ValueError(f"unknown input format: {fmt!r}")


def build(spark: SparkSession, input_path: str | list[str], store: str, *, input_format: str = "csv", rounding: str = "sql",
          read_options: dict | None = None, sort: bool = True, **params) -> Built:
    """Bring the stored groups up to date with the input; the marts are made from them."""
    options = read_options or {}
    asked = json.dumps({"format": input_format, "rounding": rounding, "options": options, **params}, sort_keys=True)
    listing = _listing(spark, input_path)
    folder, old = PB.current_version(spark, store), None
    if folder:
        known = spark.read.parquet(f"{folder}/manifest")
        same = spark.read.text(f"{folder}/asked", wholetext=True).first()[0].strip() == asked
        if same and known.join(listing, _FILE, "left_anti").isEmpty():
            old = spark.read.parquet(f"{folder}/groups")
            new = listing.join(known, _FILE, "left_anti")
    if old is None:
        new = listing
    found = new.collect()                      # the paths that the reader is to read, as its own listing would hold
    if not found and old is not None:
        return Built(SH.marts_from_groups(old, sort=sort, rounding=rounding), 0, False)
    groups = []
    if found:
        trips = _read(spark, [r["path"] for r in found], input_format, options)
        groups.append(SH.aggregate_entries(SH.mart_entries(trips, rounding=rounding, **params)))
    if old is not None:
        groups.append(old)
    if not groups:
        raise FileNotFoundError(f"no files below {input_path}")

    def write(target: str) -> None:
        merged = groups[0]
        if len(groups) > 1:
            # an INT zone of typed files and a text zone of others are different columns of the key
            merged = merge_groups(merged.unionByName(groups[1]))
        merged.write.parquet(f"{target}/groups")
        files = spark.createDataFrame(found, new.schema)
        if old is not None:
            files = files.unionByName(known.select(*_FILE))
        files.write.parquet(f"{target}/manifest")
        spark.createDataFrame([(asked,)], "value string").coalesce(1).write.text(f"{target}/asked")

    written = PB.publish(spark, store, write)
    return Built(SH.marts_from_groups(spark.read.parquet(f"{written}/groups"), sort=sort, rounding=rounding),
                 len(found), old is None)
