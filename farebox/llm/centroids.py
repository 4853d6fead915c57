"""Clusters around centroids by popcounts of bit planes.

A component x becomes the integer floor(1024 * x).  Bit b of the 64
components (two's complement) is one plane, packed into one uint64; plane b
weighs 2**b, the sign's plane -2**b.  The dot product of two
vectors is the sum, over all pairs of their planes, of both weights times the number of
ones in the AND of the planes, which is exact, and so is the squared distance
|v|**2 - 2 v.c + |c|**2.

1. A task packs its vectors; the planes are written as a table, which every round
   reads instead of the vectors.
2. The first centroids are the vectors with the smallest hashes of their ids.
3. In each round a task assigns its vectors and sums them up by cluster and component,
   so that a round shuffles at most k x components rows a task, however
   large a cluster is.  The driver holds the k centroids, nothing else.
4. The last assignment is written; its sums by cluster (k rows) join it.

Defined results: vectors that are null, have another number of components, or
have a null or non-finite one are left out; rows that repeat an id are
vectors each, and of equal ids the smaller components start first;
a null id starts no cluster but is assigned; fewer vectors than
``k`` start as many clusters; equal distances go to the smaller
number; an empty cluster keeps its centroid; sums are exact (38 digits); an empty table
gives an empty result; further columns are ignored, whatever their
names.  A component of 2**27 or more after scaling is an error, since squared distances of 64
such do not fit a long."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import ship, write_table

DIM, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, "3"
WIDEST = 28                       # planes of a component, with the sign's
_BLOCK = 4096                     # vectors compared at once


def pack(ints: np.ndarray) -> np.ndarray:
    """Planes of integer vectors: (n, 64) -> (n, WIDEST) uint64, the sign's last."""
    out = np.empty((len(ints), WIDEST), np.uint64)
    wide = np.ascontiguousarray(ints.astype("<i4"))
    for b in range(WIDEST):
        out[:, b] = np.packbits(((wide >> b) & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def narrow(planes: np.ndarray) -> np.ndarray:
    """The planes that carry information: of a run of planes equal to the sign's, one stays."""
    same = (planes == planes[:, -1:]).all(axis=0)
    return planes[:, :max(1, int(np.flatnonzero(~same).max(initial=-1)) + 2)]


def weights(n: int) -> np.ndarray:
    w = np.left_shift(np.int64(1), np.arange(n, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of all vectors of two sets of planes, (n, p) and (k, q) -> (n, k)."""
    out = np.zeros((len(a), len(b)), np.int64)
    left, right = weights(a.shape[1]), weights(b.shape[1])
    for i in range(a.shape[1]):
        for j in range(b.shape[1]):
            out += np.bitwise_count(a[:, i, None] & b[None, :, j]) * (left[i] * right[j])
    return out


def assign(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector and its squared distance."""
    c = narrow(pack(centroids))
    own = (centroids.astype(np.int64) ** 2).sum(axis=1)
    number, distance = np.empty(len(planes), np.int32), np.empty(len(planes), np.int64)
    for s in range(0, len(planes), _BLOCK):
        e = s + _BLOCK
        d = norms[s:e, None] - 2 * dots(narrow(planes[s:e]), c) + own
        number[s:e] = best = d.argmin(axis=1)
        distance[s:e] = d[np.arange(len(d)), best]
    return number, distance


def sums(planes: np.ndarray) -> np.ndarray:
    """Component-wise sums of vectors: weighted counts of ones at each place of a plane."""
    p = narrow(planes)
    bits = np.unpackbits(np.ascontiguousarray(p.T).view(np.uint8).reshape(p.shape[1], len(p), 8), axis=2, bitorder="little")
    return (bits.sum(axis=1, dtype=np.int64) * weights(p.shape[1])[:, None]).sum(axis=0)


def _packed(batches):
    for batch in batches:
        kept = batch.column("_vec")
        x = np.asarray(kept.flatten()).reshape(-1, DIM)
        ints = np.floor(SCALE * x)
        if len(ints) and np.abs(ints).max() >= 1 << (WIDEST - 1):
            raise ValueError(f"a component of {np.abs(x).max()} is too large for exact distances in a long")
        ints = ints.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_vec_id"), pa.array(list(map(bytes, pack(ints))), pa.binary()),
             pa.array((ints ** 2).sum(axis=1))], ["_vec_id", "_planes", "_norm"])


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw = b"".join(batch.column("_planes").to_pylist())
    return np.frombuffer(raw, np.uint64).reshape(-1, WIDEST), np.asarray(batch.column("_norm"))


def _summed(centroids: np.ndarray):
    """One row per cluster that has vectors in this task: number, count, sums."""
    def run(batches):
        total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            planes, norms = _matrix(batch)
            number, _ = assign(planes, norms, centroids)
            for k in np.unique(number):
                mine = planes[number == k]
                total[k] += sums(mine)
                count[k] += len(mine)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(count[some]),
             pa.array(total[some].tolist(), pa.list_(pa.int64()))], ["_cluster", "_n", "_sums"])
    return run


def _assigned(centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            number, distance = assign(*_matrix(batch), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_vec_id"), pa.array(number), pa.array(distance)], ["_vec_id", "_cluster", "_distance"])
    return run


def _moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor(sum / count) of each component of the non-empty clusters."""
    parts = table.select("_planes", "_norm").mapInArrow(_summed(centroids), "_cluster int, _n long, _sums array<long>")
    exact = "decimal(38,0)"
    rows = (parts.select("_cluster", "_n", F.posexplode("_sums").alias("_at", "_sum"))
            .groupBy("_cluster", "_at").agg(F.sum(F.col("_sum").cast(exact)).alias("_sum"), F.sum("_n").alias("_n")).collect())
    out = centroids.copy()
    for r in rows:                                   # k x components rows at most
        out[r["_cluster"], r["_at"]] = int(r["_sum"]) // r["_n"]
    return out


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS,
            rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """Per kept vector: its id, cluster, distance (squared), cluster_inertia,
    inertia, and centroid (the integer components of its cluster's final centroid)."""
    spark = df.sparkSession
    ship(spark)
    vec = F.col("_vec")
    rows = df.select(F.col(f"`{id_col}`").alias("_vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("_vec"))
    # coalesce, since a null vector or component makes a condition null
    kept = rows.where(F.coalesce(F.size(vec) == DIM, F.lit(False))).where(
        F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    id_type = rows.schema["_vec_id"].dataType
    table = write_table(kept.mapInArrow(_packed, T.StructType([
        T.StructField("_vec_id", id_type), T.StructField("_planes", T.BinaryType()), T.StructField("_norm", T.LongType())])),
        "centroid-planes")
    first = kept.where("_vec_id is not null").select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_vec_id").cast("string")), 256).alias("_h"),
        F.transform(vec, lambda x: F.floor(x * SCALE)).alias("_ints")).orderBy("_h", "_ints").limit(k).collect()
    centroids = np.array([r["_ints"] for r in first], np.int64).reshape(len(first), DIM)
    if len(centroids):
        for _ in range(rounds):
            centroids = _moved(table, centroids)
    else:                                            # no vector has an id: none starts a cluster
        table = table.limit(0)
    found = write_table(table.mapInArrow(_assigned(centroids), T.StructType([
        T.StructField("_vec_id", id_type), T.StructField("_cluster", T.IntegerType()),
        T.StructField("_distance", T.LongType())])), "centroid-assigned")
    inertia = {r["_cluster"]: int(r["_sum"]) for r in found.groupBy("_cluster").agg(
        F.sum(F.col("_distance").cast("decimal(38,0)")).alias("_sum")).collect()}      # k rows at most
    names = spark.createDataFrame(
        [(i, inertia[i], sum(inertia.values()), [int(x) for x in centroids[i]]) for i in sorted(inertia)],
        "_cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(names), "_cluster").select(    # k rows
        F.col("_vec_id").alias(id_col), F.col("_cluster").alias("cluster"), F.col("_distance").alias("distance"),
        "cluster_inertia", "inertia", "centroid")


def digests(clusters: DataFrame) -> DataFrame:
    """The registered query's columns: the centroid as the hash of its components."""
    rest = [c for c in clusters.columns if c != "centroid"]
    return clusters.select(*rest, F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))
