"""Repeated passages: seed on winnowed anchors, extend, keep maximal repeats.

A word is removed if a window of ``window`` consecutive words that covers it
also starts anywhere else, in the same document or another.

1. Seeds.  The anchor of a window is its smallest ``anchor``-word hash (the
   leftmost of equal ones), so equal windows have equal anchors at equal
   places, and neighbouring windows mostly share theirs.  An
   anchor occurrence stands for the run of windows that chose it.  Occurrences
   of anchors that are found only once are dropped by a join.
2. Extension.  The context of an occurrence is the words of its whole run.
   Occurrences with equal contexts form a class; a class of two or more is
   repeated throughout, however many its members, without looking at
   pairs.  Where an anchor has several classes, one member of each is extended word by
   word to the left and right: its windows are hashed at each distance from the anchor,
   and those of two classes or more are repeats.
3. The repeated windows of a document, joined where they overlap or touch,
   are its maximal repeats.

Anchors are compared by 64-bit hashes, contexts and windows by 128 bits.

Defined results: null texts have no words; texts shorter than a window keep
all words; rows that repeat an id and a text repeat each other's windows; null
ids are allowed; an empty table gives an empty result; further columns are
ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm import words as WD
from farebox.llm.common import ship, write_table

WINDOW, ANCHOR = 35, 12
_KEY = ["_id", "_k"]


def _choose(g: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest value of each ``span`` neighbours, the leftmost
    of equal ones."""
    best, size = np.arange(len(g)), 1

    def merged(shift):
        a, b = best[:-shift] if shift else best, best[shift:]
        return np.where(g[a] <= g[b], a, b)

    while size * 2 <= span:
        best, size = merged(size), size * 2
    return merged(span - size) if size < span else best


def occurrences(text: str | None, window: int, anchor: int):
    """Anchors of a whole text: hash, context hash, first window, number of
    windows, place of the anchor in the first window."""
    h = WD.hashes(WD.split(text))
    if len(h) < window:
        return None
    runs = WD.Runs(h)
    at = np.arange(len(h) - anchor + 1)
    g = runs(at, at + anchor)
    place = _choose(g, window - anchor + 1)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    count = np.diff(np.append(first, len(place)))
    place = place[first]
    context = WD.mix(runs(first, first + count + window - 1) + (place - first).astype(np.uint64))
    return g[place], context, first, count, place - first


def _joined(window: int, anchor: int):
    """Occurrences of all documents of a block in one batch."""
    names = ["_id", "_k", "_a", "_c", "_i", "_m", "_o"]

    def run(batches):
        for batch in batches:
            out, held = [], 0
            for i, k, t in zip(batch.column("_id").to_pylist(), batch.column("_k").to_pylist(), batch.column("_text")):
                found = occurrences(t.as_py(), window, anchor)
                if found:
                    n = len(found[0])
                    out.append((np.full(n, i), np.full(n, k), found[0].view(np.int64), found[1].view(np.int64),
                                *(x.astype(np.int32) for x in found[2:])))
                    held += n
                if held > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)
    return run


def _extend(window: int):
    """Hashes of the windows of one member of each class."""
    names = ["_a", "_l", "_w", "_c", "_n", "_j"]

    def run(batches):
        for batch in batches:
            for t, seeds in zip(batch.column("_text"), batch.column("_seeds")):
                s = {f.name: np.asarray(seeds.values.field(f.name)) for f in seeds.values.type}
                runs = WD.Runs(WD.hashes(WD.split(t.as_py())))
                row = np.repeat(np.arange(len(s["_i"])), s["_m"])
                j = np.arange(len(row)) - np.repeat(np.cumsum(s["_m"]) - s["_m"], s["_m"])
                start = s["_i"][row] + j
                w = runs(start, start + window).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["_a"][row]), pa.array((s["_o"][row] - j).astype(np.int32)), pa.array(w),
                     pa.array(s["_c"][row]), pa.array(s["_n"][row]), pa.array(j.astype(np.int32))], names)
    return run


def _cut(window: int, id_col: str):
    def run(batches):
        for batch in batches:
            size = max(1, min(batch.num_rows, int(batch.num_rows * 8e6 / max(1, batch.nbytes))))
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                n, removed, kept, spans = [], [], [], []
                for t, marks in zip(part.column("_text"), part.column("_marks")):
                    words = WD.split(t.as_py())
                    edge = np.zeros(len(words) + 1, np.int64)
                    if marks.is_valid:
                        first = np.asarray(marks.values.field("_i"))
                        mask = np.asarray(marks.values.field("_mask")).astype(np.int64)
                        bit = (mask[:, None] >> np.arange(window)) & 1
                        starts = (first[:, None] + np.arange(window))[bit == 1]
                        np.add.at(edge, starts, 1)
                        np.add.at(edge, starts + window, -1)
                    hit = np.cumsum(edge)[:-1] > 0
                    turn = np.flatnonzero(np.diff(hit, prepend=False, append=False))
                    n.append(len(words))
                    removed.append(int(hit.sum()))
                    spans.append(turn.reshape(-1, 2).tolist())
                    kept.append(b" ".join([words[i] for i in np.flatnonzero(~hit)] if removed[-1] else words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_doc"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int32())))],
                    [id_col, "n_words", "n_removed", "kept", "spans"])
    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR) -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the other words, joined by one
    space) and spans ([first, last + 1) words of each maximal repeat)."""
    ship(df.sparkSession)
    if not 0 < anchor < window or window - anchor >= 31:
        raise ValueError("a run of windows has to fit into the bits of an int")
    doc = F.col(f"`{id_col}`")
    rows = df.select(doc.alias("_doc"), F.coalesce(doc.cast("long"), F.lit(-1).cast("long")).alias("_id"),
                     F.xxhash64(doc.cast("string"), F.col(f"`{text_col}`")).alias("_k"), F.col(f"`{text_col}`").alias("_text"))
    found = write_table(rows.select("_id", "_k", "_text").mapInArrow(
        _joined(window, anchor), "_id long, _k long, _a long, _c long, _i int, _m int, _o int"), "substring-occurrences")
    # a table of its own, so that Spark can split the partition of a frequent anchor in the join
    again = write_table(found.groupBy("_a").agg(F.count("*").alias("_n")).where("_n > 1").select("_a"), "substring-again")
    seeds = write_table(found.join(again, "_a", "left_semi"), "substring-seeds")

    classes = seeds.groupBy("_a", "_c").agg(
        F.count("*").alias("_n"), F.min(F.struct("_id", "_k", "_i", "_m", "_o")).alias("_one"))
    classes = write_table(classes.select("_a", "_c", "_n", "_one.*"), "substring-classes")
    several = write_table(classes.groupBy("_a").agg(F.count("*").alias("_s")).where("_s > 1").select("_a"), "substring-several")
    one = classes.join(several, "_a", "left_semi").groupBy(*_KEY).agg(
        F.collect_list(F.struct("_a", "_c", "_n", "_i", "_m", "_o")).alias("_seeds"))
    extended = write_table(
        one.join(rows.select(*_KEY, "_text"), _KEY).select("_text", "_seeds")
        .mapInArrow(_extend(window), "_a long, _l int, _w long, _c long, _n long, _j int"), "substring-windows")
    repeated = extended.groupBy("_a", "_l", "_w").agg(F.sum("_n").alias("_s")).where("_s > 1").select("_a", "_l", "_w")
    single = extended.where("_n = 1").join(repeated, ["_a", "_l", "_w"], "left_semi").groupBy("_a", "_c").agg(
        F.bit_or(F.expr("shiftleft(1, _j)")).alias("_mask"))
    masks = classes.where("_n > 1").select("_a", "_c", F.expr("shiftleft(1, _m) - 1").alias("_mask")).unionByName(single)
    marks = write_table(seeds.join(masks, ["_a", "_c"]).groupBy(*_KEY).agg(
        F.collect_list(F.struct("_i", "_mask")).alias("_marks")), "substring-marks")
    return rows.join(marks, _KEY, "left").select("_doc", "_text", "_marks").mapInArrow(
        _cut(window, id_col), T.StructType([
            T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType())))]))
