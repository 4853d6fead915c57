"""Shared helpers of the pipeline operators."""

from __future__ import annotations

import os
from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Put the folder of this package on the Python path of the tasks.  On a
    cluster without a shared code folder the package comes with
    ``--py-files``; the extra path entry is then harmless."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Let Spark delete the shuffle files of the queries run inside."""
    old = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, old)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and return
    the table read back: the lineage is cut, and a lost executor costs a
    read.  The shuffle files of the writing job are removed with it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_REMEMBERED: dict[str, Callable[[], object]] = {}


def only(name: str, forget: Callable[[], object]) -> None:
    """Called by a task before it fills the lookup tables ``name``, which
    ``forget`` empties: a worker that served another operator before lets
    that one's tables go, so that it never holds those of several."""
    if name not in _REMEMBERED:
        for other in _REMEMBERED.values():
            other()
        _REMEMBERED.clear()
        _REMEMBERED[name] = forget
        pa.default_memory_pool().release_unused()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


ROW = "_row"


def quoted(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def row(names: list[str]) -> Column:
    """The columns as one, so that their names meet no inner name and tasks get them whatever they are."""
    return F.struct(*map(quoted, names)).alias(ROW)


def unused(names: list[str], name: str) -> str:
    """The name, with underscores until no column has it."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, rows: int = 500):
    """Parts of a batch, so that what is made of one stays small."""
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def blocks(arrays, sizes, limit: int):
    """Consecutive index ranges [a, b) whose sizes add up to ``limit`` or
    less; one item over the limit makes a range of its own."""
    a, held = 0, 0
    for i in range(len(arrays)):
        s = int(sizes[i])
        if held and held + s > limit:
            yield a, i
            a, held = i, 0
        held += s
    if a < len(arrays):
        yield a, len(arrays)
