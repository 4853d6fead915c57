"""URL filter: a sorted array of 64-bit digests, probed by binary search.

A rule is a host and the start of a path; it fits the host and all its
subdomains if the URL's path starts with the rule's.  The rules are kept in one
file: the sorted xxhash64 digests of ``host NUL path``, then the full
strings and verdicts in the same order.  ``SparkContext.addFile`` brings
the file to each executor, whose workers map it into memory.  A batch of
URLs gives all its candidates (each suffix of the host at a dot, up to the length of the longest rule's, with each path start of
a length that some rule has), which are looked up together by a vectorised
binary search; a hit counts only if the stored string is equal, so
colliding digests do no harm.  The longest fitting rule wins; without one
the verdict is ``default``.

The file takes about 8 bytes and the string per rule; it is mapped, not
loaded.  Its size is checked against ``max_bytes`` before it is sent; more rules are
split into several such files by digest, looked up one after the other.

Defined results: null URLs and URLs without ``://`` have an empty host and
path and no rule; the same rule twice counts once, with conflicting verdicts
``block`` wins; rules with a null or empty host are left out; an empty table
gives an empty result; repeated rows and ids are judged each; hosts and paths of
any length take memory in proportion; further columns are ignored, whatever their names."""

from __future__ import annotations

import mmap
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import ship

MAX_BYTES = 256 << 20
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def host_and_path(url: str | None) -> tuple[str, str]:
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return m.group(1).translate(_UPPER), m.group(2)


def digests(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def _key(host: str, path: str) -> bytes:
    return f"{host}\0{path}".encode("utf-8", "surrogatepass")


def build(rules, folder: str, max_bytes: int = MAX_BYTES) -> list[str]:
    """Rule files of (verdict, host, path) triples, each below ``max_bytes``."""
    known: dict[bytes, str] = {}
    for verdict, host, path in rules:
        if host:
            k = _key(host.translate(_UPPER), path or "")
            known[k] = "block" if "block" in (verdict, known.get(k)) else verdict
    keys = list(known)
    order = np.argsort(digests(keys), kind="stable")
    parts, held = [[]], 0
    for i in order:
        size = len(keys[i]) + 32
        if parts[-1] and held + size > max_bytes:
            parts.append([])
            held = 0
        parts[-1].append(keys[i])
        held += size
    out = []
    for own in parts:
        path = os.path.join(folder, f"url-rules-{uuid.uuid4().hex}.bin")
        text = [k + (b"\x01" if known[k] == "block" else b"\x00") for k in own]
        ends = np.cumsum([len(t) for t in text], dtype=np.int64) if text else np.empty(0, np.int64)
        with open(path, "wb") as f:
            f.write(np.array([len(own)], np.int64).tobytes())
            f.write(digests(own).tobytes())
            f.write(ends.tobytes())
            f.write(b"".join(text))
        out.append(path)
    return out


class RuleFile:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int(np.frombuffer(self.map, np.int64, 1)[0])
        self.digests = np.frombuffer(self.map, np.uint64, n, 8)
        self.ends = np.frombuffer(self.map, np.int64, n, 8 + 8 * n)
        self.base = 8 + 16 * n

    def __len__(self) -> int:
        return len(self.digests)

    def text(self, i: int) -> tuple[bytes, str]:
        a = self.base + (int(self.ends[i - 1]) if i else 0)
        raw = self.map[a:self.base + int(self.ends[i])]
        return raw[:-1], "block" if raw[-1] else "allow"

    def find(self, keys: list[bytes], hashed: np.ndarray) -> dict[int, str]:
        """Verdict by number of the key, for keys that are rules."""
        at = np.searchsorted(self.digests, hashed)
        inside = np.flatnonzero(at < len(self.digests))
        out = {}
        for k in inside[self.digests[at[inside]] == hashed[inside]]:
            i = int(at[k])
            while i < len(self.digests) and self.digests[i] == hashed[k]:  # colliding digests
                text, verdict = self.text(i)
                if text == keys[k]:
                    out[int(k)] = verdict
                    break
                i += 1
        return out


_FILES: dict[str, RuleFile] = {}


def _open(names: tuple[str, ...]) -> list[RuleFile]:
    for n in names:
        if n not in _FILES:
            _FILES[n] = RuleFile(SparkFiles.get(n))
    return [_FILES[n] for n in names]


def suffixes(host: str, longest: int | None):
    """The host and what follows each of its dots, as far as it has ``longest``
    characters or fewer: no rule fits a longer one."""
    if longest is not None and len(host) > longest:
        start = len(host) - longest
        host = host[start:] if host[start - 1] == "." else host[start:].partition(".")[2]
    while host:
        yield host
        host = host.partition(".")[2]


def judge(urls: list[str | None], files: list[RuleFile], lengths: list[int], default: str, longest: int | None = None) -> list[tuple]:
    """(host, path, rule, verdict) of each URL; ``lengths`` of the rules' paths, the ``longest`` of their hosts."""
    parsed = [host_and_path(u) for u in urls]
    number: dict[bytes, int] = {}
    own: list[list[tuple]] = []
    for host, path in parsed:
        mine = []
        for suffix in suffixes(host, longest):
            for n in lengths:
                if n <= len(path):
                    mine.append((number.setdefault(_key(suffix, path[:n]), len(number)), suffix, path[:n]))
        own.append(mine)
    keys, found = list(number), {}
    hashed = digests(keys)
    for f in files:
        found |= f.find(keys, hashed)
    out = []
    for (host, path), mine in zip(parsed, own):
        fit = [(len(h) + len(p), len(h), h + p, found[k]) for k, h, p in mine if k in found]
        best = max(fit, default=None)
        out.append((host, path, *(best[2:] if best else (None, default))))
    return out


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per row: id, host, path, rule, verdict.  ``rules``: (verdict, host, path)."""
    spark = pages.sparkSession
    ship(spark)
    folder = tempfile.mkdtemp(prefix="url-rules-")  # the driver's copy; addFile serves it to the executors
    names = []
    for path in build(rules, folder, max_bytes):
        spark.sparkContext.addFile(path)
        names.append(os.path.basename(path))
    lengths = sorted({len(p or "") for _, h, p in rules if h})
    longest = max((len(h) for _, h, _ in rules if h), default=0)
    names = tuple(names)

    def run(batches):
        for batch in batches:
            rows = judge(batch.column(1).to_pylist(), _open(names), lengths, default, longest)
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in cols)], [id_col, "host", "path", "rule", "verdict"])

    schema = T.StructType([pages.schema[id_col], *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict"))])
    return pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`")).mapInArrow(run, schema)
