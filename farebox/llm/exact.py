"""Exact duplicates through Patricia tries.

Texts are compared without their ASCII white space.  Each task first folds
its own rows in a trie, so that a text with many copies leaves the task
once for each trie it filled, not once a row.  The folded texts are shuffled by
length and content hash; the task that owns such a partition inserts the
full byte strings into a compressed radix trie, whose terminal nodes hold
the best row (most code points, then smallest id) and the number of copies.
When the labels of a trie exceed its budget, its heaviest subtree goes to a
temporary file and is resolved by itself afterwards.  The classes then join
the rows' hashes, where no text moves and Spark splits a skewed class.

Defined results: a null text counts as empty, and empty texts are copies of
each other; a null id ranks after all others; rows that repeat an id are
rows like others, counted each, and share their class's decision; an empty
table gives an empty result; further columns are ignored."""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import ROW, quoted, row, ship

SPACE = b" \t\n\x0b\x0c\r"
FOLD_BYTES = 24 << 20      # labels a task holds before it passes its texts on
OWNER_BYTES = 96 << 20     # labels an owner holds before it spills a subtree
NODE_BYTES = 250           # what a node takes besides its label
OUT_ROWS = 2000


class Node:
    __slots__ = ("label", "kids", "held", "key", "best", "count")

    def __init__(self, label: bytes):
        self.label, self.kids, self.held = label, {}, 0
        self.key = self.best = None   # of the text that ends here, if one does
        self.count = 0


class Spilled:
    """In the place of a subtree that went to a file."""
    __slots__ = ("label", "file", "rows")

    def __init__(self, label: bytes):
        self.label, self.file, self.rows = label, tempfile.TemporaryFile(), 0

    def add(self, rest: bytes, key, best, count) -> None:
        pickle.dump((rest, key, best, count), self.file)
        self.rows += 1

    def read(self) -> Iterator[tuple]:
        self.file.seek(0)
        for _ in range(self.rows):
            yield pickle.load(self.file)
        self.file.close()


def _common(label: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``text[at:]``."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == text[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    def __init__(self, budget: int | None = None):
        self.root, self.budget = Node(b""), budget
        self.terminals = 0

    @property
    def held(self) -> int:
        return self.root.held

    def insert(self, text: bytes, key, best: tuple, count: int = 1) -> None:
        node, at, path = self.root, 0, [self.root]
        while at < len(text):
            kid = node.kids.get(text[at])
            if kid is None:
                new = node.kids[text[at]] = Node(text[at:])
                path.append(new)
                self._grow(path, len(new.label) + NODE_BYTES)
                node = new
                break
            n = len(kid.label)
            if not text.startswith(kid.label, at):
                n = _common(kid.label, text, at)
                split = Node(kid.label[:n])
                kid.label = kid.label[n:]
                split.kids[kid.label[0]] = kid
                split.held = (kid.held if isinstance(kid, Node) else 0) + n + NODE_BYTES
                if isinstance(kid, Node):
                    kid.held -= n
                node.kids[text[at]] = split
                self._grow(path, NODE_BYTES)
                kid = split
            if isinstance(kid, Spilled):
                kid.add(text[at + n:], key, best, count)
                return
            path.append(kid)
            node, at = kid, at + n
        if node.best is None:
            node.key, self.terminals = key, self.terminals + 1
        node.best = best if node.best is None else min(node.best, best)
        node.count += count
        if self.budget and self.root.held > self.budget and self.terminals > 1:
            self._spill()

    @staticmethod
    def _grow(path: list[Node], by: int) -> None:
        for node in path:
            node.held += by

    def _spill(self) -> None:
        """Send out the heaviest subtree below the first real branching."""
        node, path = self.root, [self.root]
        while True:
            kids = [k for k in node.kids.values() if isinstance(k, Node)]
            if not kids:
                return
            kid = max(kids, key=lambda k: k.held)
            if len(kids) > 1 or node.best is not None or not kid.kids:
                break
            node = kid
            path.append(node)
        out = Spilled(kid.label)
        for text, n in self._walk(kid, b""):
            if isinstance(n, Spilled):
                for rest, *more in n.read():
                    out.add(text + rest, *more)
            else:
                out.add(text, n.key, n.best, n.count)
                self.terminals -= 1
        node.kids[kid.label[0]] = out
        self._grow(path, -kid.held)

    @staticmethod
    def _walk(top, text: bytes) -> Iterator[tuple[bytes, object]]:
        """(bytes from below ``top``, terminal or spilled node)."""
        todo = [(top, text)]
        while todo:
            node, text = todo.pop()
            if isinstance(node, Spilled):
                yield text, node
                continue
            if node.best is not None:
                yield text, node
            todo += [(k, text + k.label) for k in node.kids.values()]

    def texts(self) -> Iterator[tuple[bytes, object, tuple, int]]:
        """(text, key, best, count) of each distinct text; spilled subtrees
        one after the other, each in a trie of its own."""
        for text, node in self._walk(self.root, b""):
            if isinstance(node, Spilled):
                sub = Trie(self.budget)
                for row in node.read():
                    sub.insert(*row)
                for rest, *more in sub.texts():
                    yield text + rest, *more
            else:
                yield text, node.key, node.best, node.count


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(id, code points, white space removed) of each row."""
    n = pc.utf8_length(batch.column("_text")).fill_null(0).to_pylist()
    texts = batch.column("_text").cast(pa.binary())
    for i, points, t in zip(batch.column("_id").to_pylist(), n, texts):
        yield i, points, (t.as_py() or b"").translate(None, SPACE)


def _best(i, points: int) -> tuple:
    return (-points, i is None, 0 if i is None else i)


_FOLDED = "_len long, _sha binary, _text binary, _points long, _id long, _n long"
_CLASS = "_len long, _sha binary, keep_id long, group_size long"


def _folded(trie: Trie, with_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["_len", "_sha", "_text", "_points", "_id", "_n"] if with_text else ["_len", "_sha", "keep_id", "group_size"]
    kinds = ([pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()] if with_text
             else [pa.int64(), pa.binary(), pa.int64(), pa.int64()])
    rows, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for text, (length, sha), (points, none, i), count in trie.texts():
        i = None if none else i
        rows.append((length, sha, text, -points, i, count) if with_text else (length, sha, i, count))
        size += len(text) if with_text else 0
        if len(rows) >= OUT_ROWS or size > 4 << 20:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def _fold(batches):
    trie = Trie()
    for batch in batches:
        for i, points, text in _rows(batch):
            trie.insert(text, (len(text), hashlib.sha256(text).digest()), _best(i, points))
            if trie.held > FOLD_BYTES:
                yield from _folded(trie, True)
                trie = Trie()
    yield from _folded(trie, True)


def _own(batches):
    trie = Trie(OWNER_BYTES)
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("_len", "_sha", "_points", "_id", "_n")]
        for (length, sha, points, i, n), text in zip(zip(*cols), batch.column("_text")):
            trie.insert(text.as_py(), (length, sha), _best(i, points), n)
    yield from _folded(trie, False)


def _slim(batches):
    for batch in batches:
        rows = [(i, len(t), hashlib.sha256(t).digest()) for i, _, t in _rows(batch)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))],
                ["_id", "_len", "_sha"])


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: _len, _sha, keep_id, group_size."""
    ship(df.sparkSession)
    source = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return source.mapInArrow(_fold, _FOLDED).repartition("_len", "_sha").mapInArrow(_own, _CLASS)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    source = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    rows = source.mapInArrow(_slim, "_id long, _len long, _sha binary")
    return rows.join(classes(df, id_col, text_col), ["_len", "_sha"]).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay; all columns.  A row stays by its id and
    its text, so that rows of one id with different texts are judged each."""
    keep = classes(df, id_col, text_col).select(F.col("keep_id").alias("_keep"), F.col("_sha").alias("_class"))
    plain = F.coalesce(quoted(text_col), F.lit(""))
    for c in SPACE.decode():
        plain = F.replace(plain, F.lit(c), F.lit(""))
    rows = df.select(row(df.columns), quoted(id_col).alias("_id"), F.unhex(F.sha2(plain, 256)).alias("_sha"))
    return rows.join(keep, F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_sha") == F.col("_class")), "left_semi").select(f"{ROW}.*")
