"""How filters interact: which documents each of five filters removes, in every order.

The filters fail a document with fewer than ``MIN_WORDS`` words (A), with too few
distinct words (B), with too many capitals (C), with an odd symbol (D), or with the text of
a smaller id (E).

1. Texts are scanned as bytes by a table: ``CLASS`` gives each byte its class (white
   space, capital, symbol, other ASCII, lead byte, continuation byte), and ``EMITS``
   gives, for the state after the byte before and the class of this byte, what the
   transducer emits: a word begins, a word ends, a capital, a code point, a symbol.
   White space leads to the state outside of words and all else to the state
   inside, so the state is known from one byte and the whole block goes through
   the tables at once.  A document begins outside.
2. The spans of the words go into an open-addressing hash table, all words of a block at a
   time: every pending word probes its slot; an empty slot takes one of those that claim it; a word
   that meets its equal in the slot is a repeat.  Equality is verified on document,
   length and bytes, never taken from the hash; who meets another word goes on to the next slot.
3. A document becomes its failures of A to D, and its text's SHA-256.  Documents
   with equal texts, parts and labels are counted together before the shuffle, with their
   smallest id; so E takes no join, and a text that a third of all
   rows share is a few rows.
4. The counts by part, failures and labels (32 sets of failures at most) are all
   that the 120 orders look at.

Defined results: a null text is an empty one (it fails A alone, and E); a null
part is the empty string; rows that repeat an id and a text don't fail E through each
other; a null id is smaller than none, never fails E, and has no label; a
document with several labels is good or toxic if any says so; an empty
table gives an empty result; further columns are ignored, whatever their names.
Very long texts are scanned whole."""

from __future__ import annotations

import itertools
import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import blocks, only, ship, write_table

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 100, 80, 10
SYMBOLS = b"#$%&*|"
SPACE = b" \t\n\x0b\x0c\r"

# Classes of a byte, states after it, and what the transducer emits.
WHITE, CAPITAL, SYMBOL, PLAIN, LEAD, TAIL = range(6)
OUTSIDE, INSIDE = range(2)
BEGINS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = (1 << i for i in range(5))

CLASS = np.full(256, PLAIN, np.uint8)
CLASS[0x80:0xC0], CLASS[0xC0:] = TAIL, LEAD
CLASS[list(SPACE)], CLASS[65:91], CLASS[list(SYMBOLS)] = WHITE, CAPITAL, SYMBOL
NEXT = np.full(6, INSIDE, np.uint8)
NEXT[WHITE] = OUTSIDE
EMITS = np.zeros((2, 6), np.uint8)
EMITS[:, :] = IS_POINT
EMITS[:, TAIL] = 0
EMITS[:, CAPITAL] |= IS_CAPITAL
EMITS[:, SYMBOL] |= IS_SYMBOL
EMITS[OUTSIDE, 1:] |= BEGINS
EMITS[INSIDE, WHITE] |= ENDS
# The tables composed, so that a byte takes one lookup for its own part.
_STATE = NEXT[CLASS]
_EMIT = EMITS[:, CLASS]

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FEW = (np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))) - np.uint64(1)   # masks of 0 to 7 bytes
_LONG = 256                                      # bytes of a word that are taken eight at a time
_BYTES = 1 << 20                                 # of text scanned at once


def scan(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What the transducer emits at each byte; documents begin at ``starts``."""
    state = _STATE[data]
    before = np.empty_like(state)
    before[1:] = state[:-1]
    before[starts[starts < len(data)]] = OUTSIDE
    return np.where(before == INSIDE, _EMIT[INSIDE][data], _EMIT[OUTSIDE][data])


def spans(data: np.ndarray, emitted: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, length and document of each word."""
    first = np.flatnonzero(emitted & BEGINS)
    ends = np.flatnonzero(emitted & ENDS)
    # a word that reaches the end of its document has no byte that ends it
    last = offsets[1:][offsets[1:] > offsets[:-1]]
    open_ = last[_STATE[data[last - 1]] == INSIDE]
    ends = np.sort(np.concatenate((ends, open_)))
    doc = np.searchsorted(offsets, first, side="right") - 1
    return first, ends - first, doc


def _word(view: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from ``at``, of which ``left`` belong to the word."""
    x = view[at]
    return np.where(left >= 8, x, x & _FEW[np.minimum(left, 7)])


def _hashes(view: np.ndarray, first: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
    h = (doc.astype(np.uint64) << np.uint64(32)) ^ length.astype(np.uint64)
    todo, done = np.arange(len(first)), 0
    while len(todo) and done < _LONG:
        x = _word(view, first[todo] + done, length[todo] - done)
        h[todo] = (h[todo] ^ x) * _ODD
        h[todo] ^= h[todo] >> np.uint64(29)
        done += 8
        todo = todo[length[todo] > done]
    text = memoryview(view.base)
    for i in todo.tolist():
        h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(text[first[i]:first[i] + length[i]]))
    return h * _ODD >> np.uint64(8)


def _equal(view: np.ndarray, first: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[i], of one length, have the same bytes."""
    same = np.ones(len(a), bool)
    todo, done = np.arange(len(a)), 0
    while len(todo) and done < _LONG:
        left = length[a[todo]] - done
        ok = _word(view, first[a[todo]] + done, left) == _word(view, first[b[todo]] + done, left)
        same[todo[~ok]] = False
        done += 8
        todo = todo[ok & (left > 8)]
    text = memoryview(view.base)
    for i in todo.tolist():
        x, y = (text[first[j]:first[j] + length[j]] for j in (a[i], b[i]))
        same[i] = x == y
    return same


def distinct(data: np.ndarray, first: np.ndarray, length: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Number of distinct words of each document."""
    if not len(first):
        return np.zeros(docs, np.int64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    view = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))     # eight bytes from every byte on
    h = _hashes(view, first, length, doc)
    size = 1 << int(2 * len(first) - 1).bit_length()
    table = np.full(size, -1, np.int64)
    slot = (h & np.uint64(size - 1)).astype(np.int64)
    pending, new = np.arange(len(first)), np.zeros(len(first), bool)
    while len(pending):
        at = slot[pending]
        free = table[at] < 0
        table[at[free]] = pending[free]          # of several claims one stays
        owner = table[at]
        mine = owner == pending
        new[pending[mine]] = True
        rest, owner = pending[~mine], owner[~mine]
        like = (doc[rest] == doc[owner]) & (length[rest] == length[owner]) & (h[rest] == h[owner])
        like[like] = _equal(view, first, length, rest[like], owner[like])
        pending = rest[~like]
        slot[pending] = (slot[pending] + 1) & (size - 1)
    return np.bincount(doc[new], minlength=docs)


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each
    document of a block; document i is ``data[offsets[i]:offsets[i + 1]]``."""
    docs = len(offsets) - 1
    emitted = scan(data, offsets[:-1])
    first, length, doc = spans(data, emitted, offsets)

    def count(flag):
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum((emitted & flag) != 0)))
        return total[offsets[1:]] - total[offsets[:-1]]
    return {"words": np.bincount(doc, minlength=docs), "distinct": distinct(data, first, length, doc, docs),
            "capitals": count(IS_CAPITAL), "points": count(IS_POINT), "symbols": count(IS_SYMBOL)}


def _measured(batches):
    """The texts' column replaced by its measures; a block of documents at a time."""
    only("audit", lambda: None)
    names = ["words", "distinct", "capitals", "points", "symbols"]
    for batch in batches:
        text = batch.column("_text").cast(pa.large_binary())
        size = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1])
        for a, b in blocks(size, size, _BYTES):
            part = text.slice(a, b - a)
            offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
            data = (np.frombuffer(part.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0]
                    else np.zeros(0, np.uint8))
            found = measures(data, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(a, b - a) for c in ("_doc", "_part", "_sha")),
                 *(pa.array(found[n], pa.int64()) for n in names)], ["_doc", "_part", "_sha", *names])


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Per row: _doc (id), _part, _sha (SHA-256 of the text) and the transducer's counts."""
    ship(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("_doc"),
                     F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("_part"),
                     F.unhex(F.sha2(text, 256)).alias("_sha"), text.alias("_text"))
    id_type = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(_measured, f"_doc {id_type}, _part string, _sha binary, words long, distinct long, "
                                      "capitals long, points long, symbols long")


def _bits() -> Column:
    """Failures of A to D as bits 0 to 3."""
    c = F.col
    failed = [c("words") < MIN_WORDS, 100 * c("distinct") < MIN_DISTINCT_PERCENT * c("words"),
              100 * c("capitals") > MAX_CAPITAL_PERCENT * c("points"), c("symbols") > 0]
    out = F.lit(0)
    for i, f in enumerate(failed):
        out = out + F.when(f, 1 << i).otherwise(0)
    return out


def failures(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """Documents by part and set of failures (bits, A first): _n, of these _good and _toxic by their labels."""
    c = F.col
    seen = write_table(measure(df, id_col, text_col, part_col).select("_doc", "_part", "_sha", _bits().alias("_mask"))
                       .groupBy("_doc", "_part", "_sha", "_mask").agg(F.count("*").alias("_n")), "audit-documents")
    marks = write_table(labels.where(f"`{id_col}` is not null").groupBy(F.col(f"`{id_col}`").alias("_doc")).agg(
        F.coalesce(F.max(c("quality") == 1), F.lit(False)).alias("_good"),
        F.coalesce(F.max(c("toxic") == 1), F.lit(False)).alias("_toxic")), "audit-labels")
    no = F.lit(False)
    # rows without an id have no label: apart, so that they don't meet in one partition of the join
    named = seen.where("_doc is not null").join(marks, "_doc", "left").select(
        *seen.columns, F.coalesce("_good", no).alias("_good"), F.coalesce("_toxic", no).alias("_toxic"))
    rows = named.unionByName(seen.where("_doc is null").select("*", no.alias("_good"), no.alias("_toxic")))
    # a row of ``rows`` is an id with its text: the smallest id of a group has one
    alike = rows.groupBy("_sha", "_mask", "_part", "_good", "_toxic").agg(
        F.sum("_n").alias("_n"), F.min("_doc").alias("_least"),
        F.coalesce(F.min_by("_n", "_doc"), F.lit(0)).alias("_of_least"),
        F.coalesce(F.sum(F.when(c("_doc").isNull(), c("_n"))), F.lit(0)).alias("_unnamed"))
    passed = c("_unnamed") + F.when(c("_least") == c("_first"), c("_of_least")).otherwise(0)
    judged = alike.withColumn("_first", F.min("_least").over(Window.partitionBy("_sha"))).withColumn("_passed", passed)
    both = judged.select("_part", "_good", "_toxic", F.inline(F.array(
        F.struct(c("_mask"), c("_passed").alias("_n")),
        F.struct((c("_mask") + 16).alias("_mask"), (c("_n") - c("_passed")).alias("_n")))))
    return both.groupBy("_part", "_mask").agg(
        F.sum("_n").alias("_n"), F.sum(F.when(c("_good"), c("_n")).otherwise(0)).alias("_good"),
        F.sum(F.when(c("_toxic"), c("_n")).otherwise(0)).alias("_toxic"))


def orders(counts: DataFrame) -> DataFrame:
    """What each filter removes, for every part, order of the filters and step."""
    c = F.col
    steps = [{"filter_order": "".join(p), "step": i + 1, "_before": sum(1 << FILTERS.index(x) for x in p[:i]),
              "_bit": 1 << FILTERS.index(p[i])} for p in itertools.permutations(FILTERS) for i in range(len(FILTERS))]
    grid = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, _before: int, _bit: int>>")
    fails = c("_mask").bitwiseAND(c("_bit")) > 0
    earlier = c("_mask").bitwiseAND(c("_before")) > 0

    def total(cond, name, of="_n"):
        return F.sum(F.when(cond, c(of)).otherwise(0)).alias(name)
    by_step = counts.select("*", F.inline(grid)).groupBy("_part", "filter_order", "step", "_bit").agg(
        total(~earlier & ~fails, "kept"), total(~earlier & fails, "removed"), total(earlier & fails, "redundant"),
        total(c("_mask") == c("_bit"), "unique_fails"), total(~earlier & fails, "good_lost", "_good"),
        total(~earlier & fails, "toxic_lost", "_toxic"))
    return by_step.select(
        c("_part").alias("part"), "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", F.sum("removed").over(Window.partitionBy("_part", "_bit")).alias("shapley"))


def audit(df: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row per part, order of the five filters (120) and step (5)."""
    counts = write_table(failures(df, labels, **columns), "audit-counts")
    return orders(counts)
