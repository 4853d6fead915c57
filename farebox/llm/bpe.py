"""Byte-level BPE encoding and decoding by a public rank file.

Each match of the split pattern (a piece) is encoded by itself.  Distinct
pieces of a block of texts are put into padded id matrices by length bucket;
in each round every row merges its leftmost pair of minimum rank, found
through a hashed pair table; a row without a pair left is written out and
leaves the matrix, and the matrix loses a column.  Rows longer than
``LONG`` bytes also merge, in the same round, all further occurrences of
that pair where this provably gives the same result, so that the number of
rounds is bounded by the vocabulary and not by the length.

Defined results: a null text counts as empty and gives no ids; null ids
decode to no bytes; an id outside the vocabulary is an error.  Rows are
independent of each other, so ties, repeats and row order do not matter.  A
column of the input that has the name of an output column is replaced."""

from __future__ import annotations

import base64
import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import ROW, only, quoted, row, ship

BLOCK = 1 << 18       # code points tokenised, or ids decoded, at a time
LONG = 128            # bytes
CACHE = 250_000       # distinct pieces a worker remembers
_NONE = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """Byte strings by rank.  The file's size is that of the vocabulary."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    table = {int(n): base64.b64decode(b) for b, n in pairs}
    if sorted(table) != list(range(len(table))):
        raise ValueError("ranks are not 0..n-1")
    return [table[i] for i in range(len(table))]


class Tokens:
    """The byte strings by id: all that decoding needs."""

    def __init__(self, tokens: list[bytes]):
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.lens = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lens)[:-1])).astype(np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, one after the other, and their number by id."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lens)):
            raise ValueError("id outside the vocabulary")
        lens = self.lens[ids]
        out, done = np.empty(int(lens.sum()), np.uint8), 0
        for a in range(0, len(ids), BLOCK):      # gathering takes 24 bytes a byte
            part = gather(self.blob, self.starts[ids[a:a + BLOCK]], lens[a:a + BLOCK])
            out[done:done + len(part)] = part
            done += len(part)
        return out, lens


class Vocabulary(Tokens):
    """The tokens with the tables of their pairs, for encoding."""

    def __init__(self, tokens: list[bytes], pattern: str):
        super().__init__(tokens)
        self.split = regex.compile(pattern)
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for t, i in self.rank.items():
            for cut in range(1, len(t)):
                a, b = self.rank.get(t[:cut]), self.rank.get(t[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(i)
        self._hash(np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64),
                   np.array(merged, np.int32))
        # a token is safe if no pair with it ranks before the token itself
        self.safe = np.ones(len(tokens), bool)
        for side in (left, right):
            s, m = np.array(side), np.array(merged)
            self.safe[s[m < s]] = False
        self.index: dict[str, int] = {}
        self.pool = np.empty(0, np.int32)
        self.pool_lens = np.empty(0, np.int64)

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _EMPTY)
        self.values = np.full(1 << bits, _NONE)
        slot = (keys * _MIX >> self.shift).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] == _EMPTY
            at, first = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[at], self.values[at] = keys[won], values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours; _NONE where it does not merge."""
        key = left.astype(np.int64).view(np.uint64) << np.uint64(32) | right.astype(np.int64).view(np.uint64)
        out = np.full(len(key), _NONE)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slot = (key[todo] * _MIX >> self.shift).astype(np.int64)
        while len(todo):
            found = self.keys[slot]
            hit = found == key[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found != _EMPTY)
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length."""
        n, width = len(pieces), max(map(len, pieces))
        lens = np.array([len(p) for p in pieces])
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < lens[:, None]] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        rows, out = np.arange(n), [None] * n
        while len(rows):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            for i in np.flatnonzero(done):
                row = ids[i]
                out[rows[i]] = row[row >= 0]
            if done.any():
                go = ~done
                rows, ids, rank, at, best = rows[go], ids[go], rank[go], at[go], best[go]
                if not len(rows):
                    break
            r = np.arange(len(rows))
            ids[r, at] = best
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), axis=1)
            for shift in (-1, 0):  # the pairs that hold the new token
                p = at + shift
                ok = (p >= 0) & (p < rank.shape[1])
                rank[r[ok], p[ok]] = self.pairs(ids[r[ok], p[ok]], ids[r[ok], p[ok] + 1])
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        rank = self.pairs(ids[:-1], ids[1:])
        while len(rank) and (best := rank.min()) != _NONE:
            at = np.flatnonzero(rank == best)
            if self.safe[best]:  # overlapping matches: every other one of a run, from its left end
                run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            else:
                at = at[:1]
            ids[at] = best
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            new = np.zeros(len(ids), bool)
            new[at] = True
            # a pair is known by its left token; drop those of removed tokens
            rank = np.append(rank, _NONE)[keep][:-1]
            ids, new = ids[keep], np.flatnonzero(new[keep])
            for p in (new - 1, new):
                p = p[(p >= 0) & (p < len(rank))]
                rank[p] = self.pairs(ids[p], ids[p + 1])
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            if (i := self.rank.get(p)) is not None:
                out[k] = np.array([i], np.int32)
            elif len(p) > LONG:
                out[k] = self._long(p)
            else:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(k)
        for own in buckets.values():
            for a in range(0, len(own), 4096):
                part = own[a:a + 4096]
                for k, ids in zip(part, self._matrix([pieces[k] for k in part])):
                    out[k] = ids
        return out

    def _remember(self, flat: list[str]) -> None:
        if len(self.index) > CACHE:
            self.index, self.pool, self.pool_lens = {}, self.pool[:0], self.pool_lens[:0]
        new = [p for p in set(flat) if p not in self.index]
        if not new:
            return
        ids = self.encode_pieces([p.encode("utf-8") for p in new])
        for p in new:
            self.index[p] = len(self.index)
        self.pool = np.concatenate([self.pool, *ids])
        self.pool_lens = np.concatenate([self.pool_lens, [len(i) for i in ids]])
        self.pool_starts = np.concatenate(([0], np.cumsum(self.pool_lens)[:-1])).astype(np.int64)

    def _gathered(self, flat: list[str]) -> tuple[np.ndarray, np.ndarray]:
        self._remember(flat)
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        lens = self.pool_lens[at] if len(at) else np.empty(0, np.int64)
        return gather(self.pool, self.pool_starts[at] if len(at) else lens, lens), lens

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number by text."""
        ids, counts, flat, own, held = [], [], [], [], 0

        def flush():
            nonlocal flat, own, held
            got, lens = self._gathered(flat)
            ends = np.concatenate(([0], np.cumsum(lens)))
            cut = np.concatenate(([0], np.cumsum(own))).astype(np.int64)
            ids.append(got)
            counts.extend(np.diff(ends[cut]).tolist())
            flat, own, held = [], [], 0

        for t in texts:
            if len(t) > BLOCK:  # a very long text: a bounded number of pieces at a time
                if own:
                    flush()
                found, total = (m.group() for m in self.split.finditer(t)), 0
                while part := list(itertools.islice(found, BLOCK // 4)):
                    got, _ = self._gathered(part)
                    ids.append(got)
                    total += len(got)
                counts.append(total)
                continue
            pieces = self.split.findall(t)
            flat += pieces
            own.append(len(pieces))
            held += len(t)
            if held > BLOCK:
                flush()
        if own:
            flush()
        return (np.concatenate(ids) if ids else np.empty(0, np.int32)).astype(np.int32), np.array(counts, np.int64)


def gather(pool: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The ranges [start, start + len) of ``pool``, one after the other."""
    total = int(lens.sum())
    shift = np.repeat(starts - (np.cumsum(lens) - lens), lens)
    return pool[np.arange(total) + shift]


_VOCABULARIES: dict[int, Tokens] = {}


def _vocabulary(shared) -> Tokens:
    only("bpe", _VOCABULARIES.clear)
    tokens, pattern = shared.value
    key = hash((pattern, len(tokens), tokens[-1]))
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Tokens(tokens) if pattern is None else Vocabulary(tokens, pattern)
    return _VOCABULARIES[key]


def _with(df: DataFrame, keep: list[str] | None, name: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    """The columns that stay beside the new one, which replaces another of its name."""
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() != name.lower()]
    return keep, T.StructType([T.StructField(ROW, T.StructType([df.schema[c] for c in keep])), T.StructField(name, kind)])


def _source(df: DataFrame, keep: list[str], name: str):
    """The columns that stay with column ``name``, which goes to the tasks once if it is
    one of them, and what takes it from a batch."""
    if name in keep:
        at = keep.index(name)
        return df.select(row(keep)), lambda batch: batch.column(ROW).field(at)
    return df.select(row(keep), quoted(name).alias("_in")), lambda batch: batch.column("_in")


def encode(df: DataFrame, ranks: list[bytes], pattern: str, text_col: str = "text",
           ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``ids_col``, an array of ids."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))  # size of the vocabulary
    keep, schema = _with(df, keep, ids_col, T.ArrayType(T.IntegerType()))
    source, column = _source(df, keep, text_col)

    def run(batches):
        for batch in batches:
            texts = column(batch)
            step = max(1, int(batch.num_rows * 4 * BLOCK / max(1, texts.nbytes)))
            for a in range(0, batch.num_rows, step):
                part = texts.slice(a, step)
                ids, counts = _vocabulary(shared).encode([t or "" for t in part.to_pylist()])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(ROW).slice(a, len(part)), lists], [ROW, ids_col])

    return source.mapInArrow(run, schema).select(f"{ROW}.*", quoted(ids_col))


def decode(df: DataFrame, ranks: list[bytes], ids_col: str = "ids", out_col: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``out_col``, the decoded bytes."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((ranks, None))
    keep, schema = _with(df, keep, out_col, T.BinaryType())
    source, column = _source(df, keep, ids_col)

    def run(batches):
        for batch in batches:
            lists = column(batch)
            step = max(1, int(batch.num_rows * 4 * BLOCK / max(1, lists.nbytes)))
            for a in range(0, batch.num_rows, step):
                part = lists.slice(a, step)
                flat = part.flatten()
                counts = np.array(part.value_lengths().fill_null(0), np.int64)
                data, lens = _vocabulary(shared).decode(np.asarray(flat.drop_null(), np.int64))
                cut = np.concatenate(([0], np.cumsum(lens)))[np.concatenate(([0], np.cumsum(counts)))]
                texts = pa.Array.from_buffers(
                    pa.binary(), len(part), [None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([batch.column(ROW).slice(a, len(part)), texts], [ROW, out_col])

    return source.mapInArrow(run, schema).select(f"{ROW}.*", quoted(out_col))


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded and decoded rows."""
    return df.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
