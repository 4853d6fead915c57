"""Chat formatting by columnar byte assembly.

Template of a turn: ``[INST]role[/INST]text</s>``, with ``<s>`` before the
first turn of a conversation.  Within roles and texts a backslash
is doubled, and the first character of every control string
becomes a backslash with a letter, so no control string is left in them and
the text can be recovered.  Rows are shuffled by conversation and sorted by
turn; the turns of a batch become parts: one row per conversation and
batch, whose bytes are put together in one preallocated Arrow buffer from
segment lengths, cumulative offsets and scatter indices.  A conversation of
any length is a sequence of parts of bounded size, never one value.

Reading back parses the parts in order, with one running digest per
conversation.

Defined results: a null text or role counts as empty; turns that tie are
ordered by role and text, null turns come first; repeated rows are turns
of their own; null conversation ids form one conversation; an empty table
gives an empty result; further columns are ignored."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import blocks, ship

START, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (START, END, ROLE, TEXT)
LETTER = {"<": "l", "[": "b"}
PART_BYTES = 4 << 20
LOSS_ROLE = "assistant"
_BACK = {"\\\\": "\\", **{"\\" + v: k for k, v in LETTER.items()}}
_ESCAPED = re.compile(r"\\.")
_PARTS = "conv_id long, part long, formatted string, loss array<array<int>>"


def escape(texts: pa.Array) -> pa.Array:
    out = pc.replace_substring(texts, "\\", "\\\\")
    for c in CONTROLS:
        out = pc.replace_substring(out, c, "\\" + LETTER[c[0]] + c[1:])
    return out


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m.group()], text) if "\\" in text else text


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data, starts and lengths of a string column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets[:-1], np.diff(offsets)


def assemble(columns: list, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows made of segments side by side; a segment is a constant or a
    string column.  One buffer, the offset of every segment in it, and the lengths."""
    parts = []
    for c in columns:
        if isinstance(c, bytes):
            parts.append((np.frombuffer(c, np.uint8), np.zeros(n, np.int64), np.full(n, len(c), np.int64)))
        else:
            parts.append(_bytes(c))
    lens = np.stack([p[2] for p in parts], axis=1)
    ends = np.cumsum(lens.ravel())
    at = (ends - lens.ravel()).reshape(lens.shape)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k, (data, starts, size) in enumerate(parts):
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(at[:, k], size) + step] = data[np.repeat(starts, size) + step]
    return out, at, lens


def _format(part_bytes: int):
    def run(batches):
        last, part = object(), 0
        for batch in batches:
            texts = batch.column("_text").fill_null("")
            roles = batch.column("_role").fill_null("")
            sizes = pc.binary_length(texts).to_pylist()
            convs = batch.column("_conv").to_pylist()
            for a, b in blocks(sizes, sizes, part_bytes):
                n = b - a
                text, role = escape(texts.slice(a, n)), escape(roles.slice(a, n))
                change = [k for k in range(n) if (convs[a + k] != (convs[a + k - 1] if k else last))]
                first = set(change)
                start = pa.array([START if k in first else "" for k in range(n)])
                data, at, lens = assemble([start, ROLE.encode(), role, TEXT.encode(), text, END.encode()], n)
                begin = sorted(first | {0})
                row_end = at[:, -1] + lens[:, -1]
                offsets = np.concatenate((at[begin, 0], row_end[-1:])).astype(np.int32)
                formatted = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                loss = [[] for _ in begin]
                owner = np.searchsorted(begin, np.arange(n), side="right") - 1
                for k in np.flatnonzero(np.asarray(pc.equal(roles.slice(a, n), LOSS_ROLE))):
                    shift = int(offsets[owner[k]])
                    loss[owner[k]].append([int(at[k, 4]) - shift, int(at[k, 4] + lens[k, 4]) - shift])
                ids, numbers = [], []
                for k in begin:
                    part = 0 if k in first else part + 1
                    ids.append(convs[a + k])
                    numbers.append(part)
                last = convs[b - 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), formatted,
                     pa.array(loss, pa.list_(pa.list_(pa.int32())))], ["conv_id", "part", "formatted", "loss"])

    return run


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Parts in order within a partition, a conversation's parts in one
    partition: conv_id, part, formatted, loss ([start, end) bytes)."""
    ship(rows.sparkSession)
    source = rows.select(F.col(f"`{conv_col}`").cast("long").alias("_conv"), F.col(f"`{turn_col}`").alias("_turn"),
                         F.col(f"`{role_col}`").alias("_role"), F.col(f"`{text_col}`").alias("_text"))
    return source.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text").mapInArrow(
        _format(part_bytes), _PARTS)


class _Reader:
    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list) -> None:
        self.chars += len(formatted)
        raw = formatted.encode("utf-8")
        for a, b in spans:
            text = unescape(raw[a:b].decode("utf-8"))
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8"))
        for turn in formatted.removeprefix(START).split(END)[:-1]:
            role, _, text = turn.removeprefix(ROLE).partition(TEXT)
            self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8"))
            self.turns += 1

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _read(batches):
    now = None

    def batch_of(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in _READ.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        done = []
        for conv, part, text, loss in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          batch.column(2), batch.column(3).to_pylist()):
            if part == 0:
                if now:
                    done.append(now.row())
                now = _Reader(conv)
            now.add(text.as_py(), loss)
        if done:
            yield batch_of(done)
    if now:
        yield batch_of([now.row()])


def read_chats(parts: DataFrame) -> DataFrame:
    """Per conversation, from the parts as ``format_chats`` leaves them."""
    return parts.mapInArrow(_read, _READ)
