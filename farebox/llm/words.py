"""Words of a text as 64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

from farebox.llm.common import only

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BASE = np.uint64(0x9E3779B97F4A7C15)       # odd, so it has an inverse mod 2**64
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_REMEMBERED = 400_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of characters other than space and \\x09-\\x0D, in UTF-8."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.translate(LOWER) if lower else raw).split()


class _Hashes(dict):
    """Word -> hash, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_seen = _Hashes()


def hashes(words: list[bytes]) -> np.ndarray:
    only("words", _seen.clear)
    if len(_seen) > _REMEMBERED:
        _seen.clear()
    return np.fromiter(map(_seen.__getitem__, words), np.uint64, len(words))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Hash of any run of words [a, b) from sums over prefixes."""

    def __init__(self, word_hashes: np.ndarray):
        n = len(word_hashes)
        self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word_hashes * _powers(BASE, n), dtype=np.uint64)))
        self.down = _powers(_INVERSE, n + 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.prefix[b] - self.prefix[a]) * self.down[a] + (b - a).astype(np.uint64))
