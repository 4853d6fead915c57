"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Item texts (questions and answers) and documents are normalised alike: A-Z
lower-cased, words are runs of ASCII letters and digits and of all
non-ASCII characters, one space between words.  The patterns are the
windows of ``window`` consecutive item words, an item with fewer words
being one window.  Each document is scanned once; hits are kept as ranges
of words, whose places in the original text follow from the words' places.

The windows are made and folded in tasks and written as a table.  What the
automaton takes in memory is summed up first: up to ``max_bytes`` the windows go
into one automaton, which is sent to all tasks; beyond, they are split by
hash into parts of about that size.  The driver and the tasks then hold one part
at a time, each part scans the documents in a pass of its own, and the passes add up.

A window carries the ids of its items, up to ``FEW``; a window of
more (a prompt's common words) carries a reference, and its items are joined to
the documents that hold it.  So no row, part or automaton grows with a window's items.

Defined results: null or wordless texts have no words, no hits and no
items; null items and items without words have no windows; an item that
occurs twice under one id counts once.  Items with a null id drop documents as all others
do; ``find_leaks`` counts their windows if ``unnamed`` is set (as the registered
query does), and all of them stand as one null at the end of a document's items;
otherwise it leaves them out.  An empty
benchmark finds nothing; an empty table gives an empty result; texts of any length are
scanned whole; further columns are ignored or kept, whatever their names."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import ROW, only, row, ship, slices, write_table

WINDOW = 10
MAX_BYTES = 96 << 20      # memory of an automaton
NODE_BYTES, ITEM_BYTES = 40, 120   # of it, a byte of a window and an item of a window
FEW = 64                  # items that a window carries itself
# every byte that is not part of a word becomes a space; A-Z become a-z
_FOLD = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)).lower()
_WORD = re.compile(rb"[^ ]+")


def normalise(text: str | None) -> bytes:
    """Words with one space between, before and after."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: str | None, window: int = WINDOW) -> set[bytes]:
    words = normalise(text).split()
    n = min(window, len(words))
    return {b" " + b" ".join(words[i:i + n]) + b" " for i in range(len(words) - n + 1)} if n else set()


def _windows(window: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 200):
                found = [(w, i) for i, t in zip(part.column("_item").to_pylist(), part.column("_text"))
                         for w in windows(t.as_py(), window)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                    ["_w", "_item"])
    return run


def _in_order(items) -> list[str | None]:
    return sorted(items, key=lambda i: (i is None, i or ""))


def _tables(benchmark: DataFrame, id_col: str, text_col: str, window: int, unnamed: bool) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (_w, _items, _ref), and the items (_ref, _item) of those
    that have more than FEW: these carry a reference instead of their items."""
    ship(benchmark.sparkSession)
    rows = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("_item"), F.col(f"`{text_col}`").alias("_text"))
    rows = rows if unnamed else rows.where("_item is not null")
    pairs = write_table(rows.mapInArrow(_windows(window), "_w binary, _item string").distinct(), "leaks-pairs")
    many = write_table(pairs.groupBy("_w").agg(F.count("*").alias("_n")).where(F.col("_n") > FEW).select(
        "_w", F.unhex(F.sha2("_w", 256)).alias("_ref")), "leaks-many")
    null = F.when(F.max(F.col("_item").isNull()), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    few = pairs.join(many, "_w", "left_anti").groupBy("_w").agg(F.concat(F.collect_set("_item"), null).alias("_items"))
    none = F.array().cast("array<string>").alias("_items")
    table = write_table(few.withColumn("_ref", F.lit(None).cast("binary")).unionByName(many.select("_w", none, "_ref")), "leaks-windows")
    return table, pairs.join(many, "_w").select("_ref", "_item")


def _parts(table: DataFrame, max_bytes: int) -> list[DataFrame]:
    size = table.agg(F.sum(F.octet_length("_w") * NODE_BYTES + F.size("_items") * ITEM_BYTES)).first()[0] or 0
    n = max(1, -(-size // max_bytes))
    return [table.where(F.pmod(F.xxhash64("_w"), F.lit(n)) == k) if n > 1 else table for k in range(n)]


def patterns(benchmark: DataFrame, id_col: str, text_col: str, window: int, max_bytes: int,
             unnamed: bool = False) -> list[DataFrame]:
    """Distinct windows with the ids of their items (_w, _items; a reference
    in _ref where there are many), in parts of about ``max_bytes``; one part at least.  With ``unnamed``, those of items
    with a null id too, a null standing for the id."""
    return _parts(_tables(benchmark, id_col, text_col, window, unnamed)[0], max_bytes)


class Scanner:
    def __init__(self, part: dict[bytes, tuple[tuple[str | None, ...], bytes | None]]):
        self.automaton = ahocorasick.Automaton()
        for w, (items, ref) in part.items():
            self.automaton.add_word(w.decode("latin-1"), (len(w), items, ref))
        self.automaton.make_automaton()
        self.empty = not part

    def scan(self, text: str | None, ranges=(), items=(), refs=()) -> tuple[int, list[tuple[int, int]], set[str], set[bytes]]:
        """Number of words, merged ranges of hit words, items and references
        to windows of many items, together with those of earlier parts."""
        norm = normalise(text)
        n = norm.count(b" ") - 1 if norm else 0
        found, items, refs = [], set(items), set(refs)
        if norm and not self.empty:
            for end, (size, own, ref) in self.automaton.iter(norm.decode("latin-1")):
                found.append((end - size + 1, end))
                items.update(own)
                if ref:
                    refs.add(ref)
        if not found:
            return n, [tuple(r) for r in ranges], items, refs
        spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)  # word k stands after space k
        hits = zip(np.searchsorted(spaces, [f[0] for f in found]).tolist(),
                   np.searchsorted(spaces, [f[1] for f in found]).tolist())
        merged: list[list[int]] = []
        for a, b in sorted([*hits, *map(tuple, ranges)]):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        return n, [tuple(r) for r in merged], items, refs


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as [start, end) code points of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    folded = raw.translate(_FOLD)
    for b in b"\t\n\x0b\x0c\r":
        assert b not in folded
    words = [m.span() for m in _WORD.finditer(folded)]
    points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    at = lambda byte: int(points[byte - 1]) if byte else 0
    return [(at(words[a][0]), at(words[b - 1][1])) for a, b in ranges]


_SCANNERS: dict[str, Scanner] = {}


class _Shared:
    """One part, sent to all tasks; a worker builds its automaton once."""

    def __init__(self, part: DataFrame):
        rows = part.toArrow()
        windows = sorted(zip(rows.column("_w").to_pylist(), zip(
            map(tuple, map(_in_order, rows.column("_items").to_pylist())), rows.column("_ref").to_pylist())), key=lambda w: w[0])
        self.id = hashlib.sha256(repr(windows).encode("utf-8", "surrogatepass")).hexdigest()
        self.windows = part.sparkSession.sparkContext.broadcast(dict(windows))  # max_bytes or so

    def scanner(self) -> Scanner:
        only("leaks", _SCANNERS.clear)
        if self.id not in _SCANNERS:
            _SCANNERS.clear()
            _SCANNERS[self.id] = Scanner(self.windows.value)
        return _SCANNERS[self.id]


HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("_refs", T.ArrayType(T.BinaryType()))])
_SPANS, _STRINGS, _REFS = pa.list_(pa.list_(pa.int32())), pa.list_(pa.string()), pa.list_(pa.binary())


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
               max_bytes: int = MAX_BYTES, unnamed: bool = False) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted), spans ([start, end)
    code points of the original text, merged)."""
    id_type = T.StructField("_id", docs.schema[id_col].dataType)
    table, many = _tables(benchmark, item_col, item_text, window, unnamed)
    parts = _parts(table, max_bytes)

    def scan(shared: _Shared, final: bool):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                out: list[list] = [[], [], [], [], []]
                for t, before, known, refs in zip(batch.column("_text"), *(batch.column(c).to_pylist() for c in ("_ranges", "_items", "_refs"))):
                    text = t.as_py() or ""
                    n, ranges, items, refs = shared.scanner().scan(text, before, known, refs)
                    spans = original_spans(text, ranges) if final and ranges else ranges
                    for c, v in zip(out, (n, sum(b - a for a, b in ranges), _in_order(items), spans, sorted(refs))):
                        c.append(v)
                items, spans, refs = (pa.array(c, k) for c, k in zip(out[2:], (_STRINGS, _SPANS, _REFS)))
                if final:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), items, spans, refs],
                        ["_id", *HITS.names])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_id"), batch.column("_text"), spans, items, refs], ["_id", "_text", "_ranges", "_items", "_refs"])
        return run

    state = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
                        F.array().cast("array<array<int>>").alias("_ranges"), F.array().cast("array<string>").alias("_items"),
                        F.array().cast("array<binary>").alias("_refs"))
    for part in parts[:-1]:
        state = write_table(state.mapInArrow(scan(_Shared(part), False), state.schema), "leaks-found")
    found = state.mapInArrow(scan(_Shared(parts[-1]), True), T.StructType([id_type, *HITS]))
    if not many.isEmpty():
        found = _with_many(found, many)
    return found.select(F.col("_id").alias(id_col), "n_words", "n_hit", "items", "spans")


def _with_many(found: DataFrame, many: DataFrame) -> DataFrame:
    """The items of the referenced windows added: each row that has
    references meets a row per item of each, and these are summed up again."""
    rows = write_table(found.withColumn("_row", F.monotonically_increasing_id()), "leaks-hits")   # written, so a row keeps its number
    more = rows.select("_row", F.explode("_refs").alias("_ref")).join(write_table(many, "leaks-items"), "_ref").groupBy("_row").agg(
        F.collect_set("_item").alias("_more"), F.max(F.col("_item").isNull()).alias("_null"))
    null = F.array(F.lit(None).cast("string"))
    items = F.when(F.col("_more").isNull(), F.col("items")).otherwise(F.array_sort(F.array_union(
        F.array_union("items", "_more"), F.when(F.col("_null"), null).otherwise(F.array().cast("array<string>")))))
    return rows.join(more, "_row", "left").withColumn("items", items)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", window: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows without any hit; all columns, nothing is shuffled."""
    at = docs.columns.index(text_col)
    parts = patterns(benchmark, item_col, item_text, window, max_bytes, unnamed=True)

    def clean(shared: _Shared):
        def run(batches):
            for part in (p for batch in batches for p in slices(batch)):
                good = [not shared.scanner().scan(t.as_py())[1] for t in part.column(0).field(at)]
                yield part.filter(pa.array(good, pa.bool_()))
        return run

    rows = docs.select(row(docs.columns))
    for part in parts[:-1]:
        rows = write_table(rows.mapInArrow(clean(_Shared(part)), rows.schema), "leaks-clean")
    return rows.mapInArrow(clean(_Shared(parts[-1])), rows.schema).select(f"{ROW}.*")


def digests(hits: DataFrame) -> DataFrame:
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
