"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams of one and two tokens (words, runs of
punctuation) and of one to three token shapes, hashed into
``2 ** BITS`` columns.  Class counts of all labelled training rows are summed by Spark; each
indicator is scaled by its log-count ratio r, the row is scaled to unit length, and a
linear hinge-loss model is fitted by dual coordinate descent over a bounded
sample of the training rows (``max_fit_rows``, smallest hash of the id
first, rare class first; ``max_fit_bytes`` of vectors, which the driver holds).  A logistic curve over margins from cross-fitting turns the
margin into a score between 0 and 1.  Scoring reads whole texts.

Defined results: null texts count as empty; an empty text has no features
and is scored from the intercept alone; labels that are null or not 0/1 are not
learned from; with one class or none to learn from, the score is the share
of class 1 (1 without labels).  Repeated ids and labels count as rows.
Labels, language, source and id never enter a score.  An empty table gives an
empty result; very long texts are read whole, in blocks; further columns are
ignored or kept, whatever their names."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import ROW, only, row, ship, slices, write_table

BITS = 18
MAX_FIT_ROWS, MAX_FIT_BYTES = 10_000, 256 << 20     # of the sample's vectors, 4 bytes an n-gram
THRESHOLD = 0.3
BLOCK = 1 << 20           # code points of a text handled at once
_TOKEN = re.compile(r"\w+|[^\w\s]+|\n")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def shape(t: str) -> str:
    if t[0].isalpha():
        size = "1" if len(t) < 4 else "4" if len(t) < 10 else "9" if len(t) < 20 else "20"
        return ("U" if t.isupper() and len(t) > 1 else "C" if t[0].isupper() else "l") + size
    return "d" if t[0].isdigit() else t[:3]


class Places(dict):
    """Token -> number, new tokens in order of appearance."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, token: str) -> int:
        n = self[token] = len(self)
        self.new.append(token)
        return n


class Hasher:
    """Hashes of tokens and of their shapes, remembered by token."""

    def __init__(self):
        self.places = Places()
        self.hashes = np.empty((0, 2), np.uint64)

    def __call__(self, tokens: list[str]) -> np.ndarray:
        if len(self.places) > 400_000:
            self.__init__()
        at = np.fromiter(map(self.places.__getitem__, tokens), np.int64, len(tokens))
        if new := self.places.new:
            end = len(self.places)
            if end > len(self.hashes):
                self.hashes = np.concatenate((self.hashes, np.zeros((end + 4096, 2), np.uint64)))
            for col, own in enumerate((str.lower, shape)):
                self.hashes[end - len(new):end, col] = [
                    xxhash.xxh3_64_intdigest(own(t).encode("utf-8", "surrogatepass"), col) for t in new]
            self.places.new = []
        return self.hashes[at]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


_HASHER = Hasher()
_SHIFT = np.uint64(64 - BITS)


def _columns(tokens: list[str]) -> np.ndarray:
    hashed = _HASHER(tokens)
    word, form = hashed[:, 0], hashed[:, 1]
    two, forms = word[:-1] * _M1 + word[1:], form[:-1] * _M1 + form[1:]
    words = _mix(np.concatenate((word, two))) >> _SHIFT
    forms = distinct(np.concatenate((form, forms, forms[:-1] * _M1 + form[2:])))  # few, and mostly repeated
    return np.concatenate((words, _mix(forms) >> _SHIFT)).astype(np.int32)


def features(text: str | None) -> np.ndarray:
    """Sorted columns of the n-grams of a whole text."""
    only("quality", _HASHER.__init__)
    text = text or ""
    if len(text) <= BLOCK:
        tokens = _TOKEN.findall(text)
        return distinct(_columns(tokens)) if tokens else np.empty(0, np.int32)
    out, found, tail = np.empty(0, np.int32), (m.group() for m in _TOKEN.finditer(text)), []
    while part := list(itertools.islice(found, BLOCK // 4)):
        out = distinct(np.concatenate((out, _columns(tail + part))))
        tail = part[-2:]
    return out


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _count(batches):
    """Per task, rows with each feature by class; key -1: rows of the class."""
    counts = np.zeros((2, (1 << BITS) + 1), np.int64)
    for batch in batches:
        for label, t in zip(batch.column("_y").to_pylist(), batch.column("_text")):
            counts[label, features(t.as_py())] += 1
            counts[label, -1] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.where(at == 1 << BITS, -1, at).astype(np.int32)), pa.array(counts[0, at]), pa.array(counts[1, at])],
        ["_f", "_n0", "_n1"])


def _vectors(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("_y"), pa.array([features(t.as_py()).tobytes() for t in batch.column("_text")], pa.binary())],
            ["_y", "_x"])


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: np.ndarray,
                 epochs: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Hinge loss with an L2 norm, by dual coordinate descent.  Row i has the
    values ``scale[rows[i]]``, brought to length 1, and a constant 1."""
    w, b, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    values = []
    for x in rows:
        v = scale[x]
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm else v)
    square = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = y[i] * (w[x] @ v + b) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if step := (new - alpha[i]) * y[i]:
                w[x] += step * v
                b += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, b


def margins(rows, scale, w, b) -> np.ndarray:
    out = np.full(len(rows), b)
    for i, x in enumerate(rows):
        v = scale[x]
        norm = np.sqrt(v @ v)
        if norm:
            out[i] += (w[x] @ v) / norm
    return out


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, with smoothed
    targets, by Newton steps."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([m, np.ones(len(m))], axis=1)
    p = np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - q) - 1e-6 * p)
        p += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(p[0], 1e-3)), float(p[1])


class Model:
    """``weights`` over scaled indicators; None: a constant score."""

    def __init__(self, scale, weights, offset, curve, constant=None):
        self.scale, self.weights, self.offset, self.curve, self.constant = scale, weights, offset, curve, constant

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        m = margins([features(text)], self.scale, self.weights, self.offset)[0]
        z = self.curve[0] * m + self.curve[1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _bounded(sample: DataFrame, rows: int, size: int) -> DataFrame:
    """The vectors, or those with the smallest hashes as far as they stay
    within the bounds: ids may repeat, and texts may be very long."""
    table = write_table(sample.withColumn("_k", F.xxhash64("_y", "_x")), "quality-sample")
    first = table.select("_k", F.octet_length("_x").alias("_b")).orderBy("_k").limit(rows + 1).collect()
    held = np.cumsum([r["_b"] for r in first])
    over = np.flatnonzero((held > size) | (np.arange(len(first)) >= rows))
    if not len(over):
        return table
    cut = first[over[0]]["_k"]
    if cut == first[0]["_k"]:                    # one vector, repeated beyond the bounds
        return table.where(F.col("_k") == cut).limit(1)
    return table.where(F.col("_k") < cut)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_fit_rows: int = MAX_FIT_ROWS, smooth: float = 1.0,
        max_fit_bytes: int = MAX_FIT_BYTES) -> Model:
    """Learn from the labelled rows that are not held out."""
    spark = docs.sparkSession
    ship(spark)
    y = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_y")).where(
        F.col("_y").isin(0, 1) & ~held_out("_id"))
    train = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).where(
        ~held_out("_id")).join(y.hint("merge"), "_id")  # the same plan at every size
    # at most 2 ** BITS + 1 rows, whatever the number of documents
    sums = train.select("_y", "_text").mapInArrow(_count, "_f int, _n0 long, _n1 long").groupBy("_f").agg(
        F.sum("_n0").alias("_n0"), F.sum("_n1").alias("_n1")).toArrow()
    f, n0, n1 = (np.asarray(sums.column(c)) for c in ("_f", "_n0", "_n1"))
    total0, total1 = (int(n[f == -1].sum()) for n in (n0, n1))
    if not total0 or not total1:
        return Model(None, None, 0.0, None, constant=total1 / (total0 + total1) if total0 + total1 else 1.0)
    count0, count1 = np.zeros(1 << BITS), np.zeros(1 << BITS)
    count0[f[f >= 0]], count1[f[f >= 0]] = n0[f >= 0], n1[f >= 0]
    scale = np.log((count1 + smooth) / (total1 + 2 * smooth)) - np.log((count0 + smooth) / (total0 + 2 * smooth))
    scale[(count0 + count1) < 2] = 0.0
    rare, share = (0, total0) if total0 < total1 else (1, total1)
    take = min(share, max_fit_rows // 2)
    ordered = lambda d, n: d.orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = ordered(y.where(F.col("_y") == rare), take).unionByName(
        ordered(y.where(F.col("_y") != rare), max_fit_rows - take))  # max_fit_rows ids
    sample = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(
        chosen, "_id").select("_y", "_text").mapInArrow(_vectors, "_y int, _x binary")
    sample = _bounded(sample, max_fit_rows, max_fit_bytes).toArrow()
    target = np.asarray(sample.column("_y"))
    rows = [np.frombuffer(x.as_py(), np.int32) for x in sample.column("_x")]
    order = sorted(range(len(rows)), key=lambda i: (target[i], rows[i].tobytes()))
    target, rows = target[order], [rows[i] for i in order]
    sign = np.where(target == 1, 1.0, -1.0)
    cost = np.where(target == 1, 0.5 * len(target) / max(1, (target == 1).sum()),
                    0.5 * len(target) / max(1, (target == 0).sum()))
    out = np.zeros(len(rows))
    fold = np.arange(len(rows)) % 3
    for k in range(3):  # margins of rows that the model has not seen
        own = np.flatnonzero(fold != k)
        w, b = dual_descent([rows[i] for i in own], sign[own], scale, cost[own], epochs=6)
        there = np.flatnonzero(fold == k)
        out[there] = margins([rows[i] for i in there], scale, w, b)
    curve = _logistic(out, target)
    # the sample holds more of the rare class than the corpus does
    prior = np.log(total1 / total0) - np.log(max(1, (target == 1).sum()) / max(1, (target == 0).sum()))
    w, b = dual_descent(rows, sign, scale, cost)
    return Model(scale, w, b, (curve[0], curve[1] + float(prior)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shared.value.score(t.as_py()) for t in batch.column(1)], pa.float64())],
                [id_col, "score"])

    scored = docs.select(f"`{id_col}`", F.col(f"`{text_col}`").alias("_text")).mapInArrow(
        run, T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())]))
    return scored.select(f"`{id_col}`", held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_rejects(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score the threshold or more; all columns."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for part in (p for batch in batches for p in slices(batch)):
            good = [shared.value.score(t.as_py()) >= threshold for t in part.column(0).field(at)]
            yield part.filter(pa.array(good, pa.bool_()))

    rows = docs.select(row(docs.columns))
    return rows.mapInArrow(run, rows.schema).select(f"{ROW}.*")
