"""Repeated byte strings, found in run-length indexes of the places that may repeat.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else, in the same document or another.

1. Places.  The anchor of a window of ``length`` bytes is its ``gram``-byte
   string with the smallest hash (the leftmost of equal ones), so equal windows have equal
   anchors at equal places, and neighbouring windows mostly share theirs.  An
   occurrence of an anchor stands for the run of windows that chose it, its
   context for the bytes of that run.  Anchors found once are dropped by a join; equal
   contexts of an anchor are one class with a count, as a copy adds no run to an index.
2. Index.  The contexts of an anchor, one of each class with its count, go with
   those of other anchors into one ``RunIndex`` (``rindex.py``), about 128 KB each: the run-length Burrows-Wheeler transform with sampled run ends.  The
   matching statistics streamed from its samples say which windows have a match of
   ``length`` bytes elsewhere.  The bytes themselves are compared, hashes only bring them together.
3. Anchors with more than ``group_bytes`` of contexts (a passage that a third of all
   documents hold, each between other words) are split: windows that are equal have the
   anchor at the same offset, so they are dealt by range of
   offsets and by the hash of the bytes that all windows of the range
   cover.  Equal parts are folded again.  What is still too large is split by a shorter range,
   down to single windows, where equal keys mean equal classes.  Nothing is capped, and the work stays linear.
4. The marks of the classes go back to all occurrences, and the documents are cut.

Contexts of an anchor are folded by 64-bit hashes beside the anchor's own 64 bits.

Defined results: null texts have no bytes; texts shorter than ``length`` keep
all; rows that repeat an id and a text repeat each other's strings; null ids are
allowed; texts of any length are read whole, in pieces; what is left of a text may cut a
character, so it is binary; an empty table gives an empty result; further
columns are ignored, whatever their names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import only, ship, write_table
from farebox.llm.rindex import RunIndex

LENGTH, GRAM = 400, 32
GROUP_BYTES = 1 << 18          # contexts of one key in one index
_INDEX_BYTES = 1 << 17         # contexts of several keys in one index: what a core caches
_PIECE = 1 << 19               # bytes hashed at once
_PLACE = np.uint64((1 << 21) - 1)
_DOC = ["_id", "_k"]
_C1, _C2, _C3, _C4 = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on; ``gram`` is 8 times a power of two."""
    h = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)) * _C1
    h ^= h >> np.uint64(29)
    size = 8
    while size < gram:
        h = h[:-size] * _C2 + h[size:] * _C3
        size *= 2
    h ^= h >> np.uint64(32)
    h *= _C4
    return h ^ (h >> np.uint64(29))


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` neighbours."""
    size = 1
    while size * 2 <= span:
        values, size = np.minimum(values[:-size], values[size:]), size * 2
    return np.minimum(values[:size - span], values[span - size:]) if size < span else values


def occurrences(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor, of the documents of a block: document,
    anchor hash, first window (place in ``data``), number of windows, place of the anchor in the first."""
    if len(data) < length:
        return None
    fits = np.ones(len(data), bool)
    for a, b in zip(offsets[:-1], offsets[1:]):
        fits[max(a, b - length + 1):b] = False
    windows = np.flatnonzero(fits)
    if not len(windows):
        return None
    h = gram_hashes(data, gram)
    best = _smallest((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    place = (best[windows] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    start, count, place = windows[first], np.diff(np.append(first, len(windows))), place[first]
    doc = np.searchsorted(offsets, start, side="right") - 1
    return doc, h[place], start, count, place - start


def _pieces(sizes: np.ndarray, length: int):
    """Blocks of documents [a, b) of at most _PIECE bytes; a longer document alone, in overlapping pieces [s, e)."""
    a, held = 0, 0
    for i, s in enumerate(sizes.tolist()):
        if held and held + s > _PIECE:
            yield a, i, 0, held
            a, held = i, 0
        held += s
        if held > _PIECE:                        # document i alone
            for p in range(0, s - length + 1, _PIECE):
                yield a, a + 1, p, min(s, p + _PIECE + length - 1)
            a, held = i + 1, 0
    if held:
        yield a, len(sizes), 0, held


def _offsets(text: pa.Array) -> np.ndarray:
    return np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]


def _located(length: int, gram: int):
    """Occurrences of the anchors of whole texts."""
    names = ["_id", "_k", "_a", "_c", "_i", "_m", "_o"]

    def run(batches):
        only("byte repeats", lambda: None)
        for batch in batches:
            text = batch.column("_text").cast(pa.large_binary())
            if not text.nbytes:
                continue
            offsets, raw = _offsets(text), text.buffers()[2]
            ids, keys = np.asarray(batch.column("_id")), np.asarray(batch.column("_k"))
            for a, b, s, e in _pieces(np.diff(offsets), length):
                base = int(offsets[a]) + s
                data = np.frombuffer(raw, np.uint8)[base:base + e - s]
                edges = np.clip(offsets[a:b + 1] - base, 0, e - s)
                found = occurrences(data, edges, length, gram)
                if found is None:
                    continue
                doc, anchor, start, count, place = found
                view, digest = memoryview(data), xxhash.xxh3_64_intdigest
                context = np.fromiter(
                    (digest(view[x:y], o) for x, y, o in zip(start.tolist(), (start + count + length - 1).tolist(), place.tolist())),
                    np.uint64, len(start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + doc]), pa.array(keys[a + doc]), pa.array(anchor.view(np.int64)),
                     pa.array(context.view(np.int64)), pa.array(start - edges[doc] + s),
                     pa.array(count.astype(np.int32)), pa.array(place.astype(np.int32))], names)
    return run


_CONTEXT = "_key long, _c long, _n long, _o int, _m int, _bytes binary"


def _contexts(length: int):
    """The contexts of the classes that a document stands for."""
    names = ["_key", "_c", "_n", "_o", "_m", "_bytes"]

    def run(batches):
        for batch in batches:
            for text, seeds in zip(batch.column("_text"), batch.column("_seeds")):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                s = {f.name: seeds.values.field(f.name) for f in seeds.values.type}
                parts = [raw[i:i + m + length - 1] for i, m in zip(s["_i"].to_pylist(), s["_m"].to_pylist())]
                for a in range(0, len(parts), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [*(s[n].slice(a, 10_000) for n in ("_a", "_c", "_n", "_o", "_m")), pa.array(parts[a:a + 10_000], pa.binary())], names)
    return run


def _split(length: int, step: int):
    """Each context as the parts whose windows have the anchor in one range of ``step`` offsets."""
    names = ["_key", "_c", "_n", "_o", "_m", "_bytes", "_parent", "_pc", "_j"]

    def run(batches):
        for batch in batches:
            rows = []
            for key, c, n, o, m, raw in zip(*(batch.column(x).to_pylist() for x in ("_key", "_c", "_n", "_o", "_m", "_bytes"))):
                for q in range((o - m + 1) // step, o // step + 1):
                    j, end = max(0, o - q * step - step + 1), min(m, o - q * step + 1)
                    core = raw[o - q * step:o - q * step + length - step + 1]
                    digest = xxhash.xxh3_64(core, q)
                    digest.update(key.to_bytes(8, "little", signed=True))
                    part = raw[j:end + length - 1]
                    rows.append((digest.intdigest(), xxhash.xxh3_64_intdigest(part, o - j), n, o - j, end - j, part, key, c, j))
                    if len(rows) == 5_000:
                        yield _batch(rows, names)
                        rows = []
            if rows:
                yield _batch(rows, names)
    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    key, c, n, o, m, part, parent, pc, j = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(np.array(c, np.uint64).view(np.int64)),
         pa.array(n, pa.int64()), pa.array(o, pa.int32()), pa.array(m, pa.int32()), pa.array(part, pa.binary()),
         pa.array(parent, pa.int64()), pa.array(pc, pa.int64()), pa.array(j, pa.int32())], names)


def _marked(keys: list[tuple[int, int]], strings: list[bytes], counts: list[int], length: int) -> pa.RecordBatch:
    """The repeated windows of the contexts of one index, as bits."""
    repeated = RunIndex(strings, counts).repeated(length)
    rows = [(k, c, np.packbits(r, bitorder="little").tobytes()) for (k, c), r in zip(keys, repeated) if r.any()]
    key, c, bits = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(c, pa.int64()), pa.array(bits, pa.binary())],
                                      ["_key", "_c", "_bits"])


def _indexed(length: int):
    """One index after another over contexts sorted by key; a key's contexts are in one index."""
    def run(batches):
        keys, strings, counts, held, here, last = [], [], [], 0, set(), None
        for batch in batches:
            for key, c, n, raw in zip(*(batch.column(x).to_pylist() for x in ("_key", "_c", "_n", "_bytes"))):
                if key != last:
                    if held > _INDEX_BYTES:
                        yield _marked(keys, strings, counts, length)
                        keys, strings, counts, held = [], [], [], 0
                    here, last = set(), key
                if c in here:                    # rows that repeat an id and a text give a context each
                    continue
                here.add(c)
                keys.append((key, c))
                strings.append(raw)
                counts.append(n)
                held += len(raw)
        if keys:
            yield _marked(keys, strings, counts, length)
    return run


def _indexes(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows (bits) of the contexts, by key and class."""
    dealt = contexts.select("_key", "_c", "_n", "_bytes").repartition("_key").sortWithinPartitions("_key")
    return dealt.mapInArrow(_indexed(length), "_key long, _c long, _bits binary")


def _gathered(batches):
    """The bits of a context from those of its parts."""
    for batch in batches:
        out = []
        for m, parts in zip(batch.column("_m").to_pylist(), batch.column("_parts").to_pylist()):
            flags = np.zeros(m, np.uint8)
            for p in parts:
                bits = np.unpackbits(np.frombuffer(p["_bits"], np.uint8), bitorder="little")[:m - p["_j"]]
                flags[p["_j"]:p["_j"] + len(bits)] |= bits
            out.append(np.packbits(flags, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("_c"), pa.array(out, pa.binary())], ["_key", "_c", "_bits"])


def _steps(span: int) -> list[int]:
    steps = []
    while span > 1:
        span = -(-span // 8)
        steps.append(span)
    return steps


def _repeated(contexts: DataFrame, sizes: DataFrame, length: int, gram: int, group_bytes: int) -> DataFrame:
    """Repeated windows of all contexts; ``sizes`` has bytes by key."""
    def large(sizes):
        return write_table(sizes.where(F.col("_size") > group_bytes).select("_key"), "bytes-large")

    found, levels = [], []
    hot = large(sizes)
    steps = _steps(length - gram + 1)
    while steps and not hot.isEmpty():
        step = steps.pop(0)
        found.append(_indexes(contexts.join(hot, "_key", "left_anti"), length))
        pending = contexts.join(hot, "_key", "left_semi")
        parts = write_table(pending.mapInArrow(_split(length, step), f"{_CONTEXT}, _parent long, _pc long, _j int"), "bytes-parts")
        levels.append((write_table(pending.select("_key", "_c", "_m"), "bytes-split"),
                       parts.select("_key", "_c", "_parent", "_pc", "_j")))
        contexts = write_table(parts.groupBy("_key", "_c").agg(
            F.sum("_n").alias("_n"), F.first("_o").alias("_o"), F.first("_m").alias("_m"), F.first("_bytes").alias("_bytes")),
            "bytes-folded")
        hot = large(contexts.groupBy("_key").agg(F.sum(F.length("_bytes")).alias("_size")))
    marks = _indexes(contexts, length)
    while levels:                                # bits of the parts, back to what was split
        whole, links = levels.pop()
        marks = write_table(marks, "bytes-part-marks")
        parts = links.join(marks, ["_key", "_c"]).groupBy(F.col("_parent").alias("_key"), F.col("_pc").alias("_c")).agg(
            F.collect_list(F.struct("_j", "_bits")).alias("_parts"))      # as many as a context has windows
        marks = parts.join(whole.dropDuplicates(["_key", "_c"]), ["_key", "_c"]).select("_key", "_c", "_m", "_parts").mapInArrow(
            _gathered, "_key long, _c long, _bits binary").unionByName(found.pop())
    return marks


def _cut(length: int, id_col: str):
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept", "spans"]

    def run(batches):
        for batch in batches:
            size = max(1, min(batch.num_rows, int(batch.num_rows * 8e6 / max(1, batch.nbytes))))
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                text = part.column("_text").cast(pa.large_binary())
                offsets, raw = _offsets(text), text.buffers()[2]
                sizes, kept, spans = np.diff(offsets), [], []
                for start, n, marks in zip(offsets.tolist(), sizes.tolist(), part.column("_marks")):
                    whole = memoryview(raw)[start:start + n] if n else b""
                    if not marks.is_valid:
                        kept.append(bytes(whole))    # pa.array keeps a reference to a view for good, and so the batch
                        spans.append([])
                        continue
                    begins = np.zeros(n, np.int32)
                    for i, m, bits in zip(*(marks.values.field(x).to_pylist() for x in ("_i", "_m", "_bits"))):
                        begins[i:i + m] |= np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[:m]
                    hit = np.cumsum(begins)
                    hit[length:] -= hit[:-length].copy()
                    turn = np.flatnonzero(np.diff(hit > 0, prepend=False, append=False)).reshape(-1, 2)
                    left = np.concatenate(([0], turn[:, 1])).tolist(), np.concatenate((turn[:, 0], [n])).tolist()
                    kept.append(b"".join(whole[x:y] for x, y in zip(*left)))
                    spans.append(turn.tolist())
                removed = [sum(y - x for x, y in s) for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_doc"), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(map(len, spans), pa.int64()),
                     pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.list_(pa.int64())))], names)
    return run


def remove_long_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                        gram: int = GRAM, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept (the other bytes) and
    spans ([first, last + 1) bytes of each maximal removed run)."""
    if gram not in (8, 16, 32, 64) or not gram <= length < (1 << 20):
        raise ValueError("gram has to be 8, 16, 32 or 64, and a window at least as long")
    ship(df.sparkSession)
    doc, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = df.select(doc.alias("_doc"), F.coalesce(doc.cast("long"), F.lit(-1).cast("long")).alias("_id"),
                     F.xxhash64(doc.cast("string"), text).alias("_k"), F.coalesce(text, F.lit("")).alias("_text"))
    found = write_table(rows.select(*_DOC, "_text").mapInArrow(
        _located(length, gram), "_id long, _k long, _a long, _c long, _i long, _m int, _o int"), "bytes-occurrences")
    # tables of their own, so that Spark can split the partition of a frequent anchor or class in a join
    again = write_table(found.groupBy("_a").agg(F.count("*").alias("_n")).where("_n > 1").select("_a"), "bytes-again")
    seeds = write_table(found.join(again, "_a", "left_semi"), "bytes-seeds")
    classes = write_table(seeds.groupBy("_a", "_c").agg(
        F.count("*").alias("_n"), F.min(F.struct("_id", "_k", "_i", "_m", "_o")).alias("_one")).select("_a", "_c", "_n", "_one.*"),
        "bytes-classes")
    one = classes.groupBy(*_DOC).agg(F.collect_list(F.struct("_a", "_c", "_n", "_i", "_m", "_o")).alias("_seeds"))
    contexts = write_table(one.join(rows.select(*_DOC, "_text"), _DOC).select("_text", "_seeds").mapInArrow(
        _contexts(length), _CONTEXT), "bytes-contexts")
    sizes = classes.groupBy(F.col("_a").alias("_key")).agg(F.sum(F.col("_m") + (length - 1)).alias("_size"))
    marked = write_table(_repeated(contexts, sizes, length, gram, group_bytes).withColumnRenamed("_key", "_a"), "bytes-marked")
    marks = write_table(seeds.join(marked, ["_a", "_c"]).groupBy(*_DOC).agg(
        F.collect_list(F.struct("_i", "_m", "_bits")).alias("_marks")), "bytes-marks")
    return rows.join(marks, _DOC, "left").select("_doc", "_text", "_marks").mapInArrow(
        _cut(length, id_col), T.StructType([
            T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
            T.StructField("kept", T.BinaryType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))]))
