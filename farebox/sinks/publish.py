"""Marts published as a whole: versions beside each other, and a pointer.

Overwriting a folder removes the old mart when the job starts, so a reader in between, or after
a failure, finds none.  Here a build writes a version of its own below
``<output>/versions``; only when all its marts are written does the small file
``<output>/CURRENT`` come to name it, by one rename that replaces the old file.  A
reader that resolves the pointer sees the marts of one build, the old ones or the
new ones; a build that fails leaves the pointer alone.

The pointer lists the versions that may be read, the current one first.  Those
that drop off its end are removed; folders of failed builds stay and are never listed."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farebox.session import remove_folder
from farebox.sources import marts as MS

POINTER, VERSIONS, KEEP = "CURRENT", "versions", 3


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _read_pointer(spark: SparkSession, output: str) -> list[str]:
    p = _path(spark, f"{output}/{POINTER}")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.split()


def _write_pointer(spark: SparkSession, output: str, versions: list[str]) -> None:
    """A new file beside the old one, renamed over it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, pointer = _path(spark, f"{output}/.{POINTER}-{uuid.uuid4().hex}"), _path(spark, f"{output}/{POINTER}")
    conf = spark._jsc.hadoopConfiguration()
    stream = new.getFileSystem(conf).create(new, True)
    try:
        stream.write(bytearray("\n".join(versions).encode()))
    finally:
        stream.close()
    over = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(pointer.toUri(), conf).rename(new, pointer, over)


def current_version(spark: SparkSession, output: str) -> str | None:
    """Folder of the current version, or None if nothing has been published."""
    versions = _read_pointer(spark, output.rstrip("/"))
    return f"{output.rstrip('/')}/{VERSIONS}/{versions[0]}" if versions else None


def publish(spark: SparkSession, output: str, write: Callable[[str], object], *, keep: int = KEEP) -> str:
    """Call ``write`` with the folder of a new version, then make it current.
    The last ``keep`` versions stay readable, for readers that resolved the pointer before."""
    output = output.rstrip("/")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{output}/{VERSIONS}/{name}"
    write(folder)
    listed = [name, *_read_pointer(spark, output)]
    _write_pointer(spark, output, listed[:max(1, keep)])
    for old in listed[max(1, keep):]:
        remove_folder(spark, f"{output}/{VERSIONS}/{old}")
    return folder


READERS = {"tsv": MS.read_mart_tsv, "csv": MS.read_mart_csv, "json": MS.read_mart_json}


def read_published(spark: SparkSession, output: str, mart: str, fmt: str = "csv") -> DataFrame:
    """The mart as last published; ``LookupError`` if nothing has been."""
    folder = current_version(spark, output)
    if folder is None:
        raise LookupError(f"nothing published in {output}")
    return READERS[fmt](spark, f"{folder}/{mart}", mart)
