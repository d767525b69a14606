"""Hashed words, shingles and MinHash values of whole texts, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None, lower: bool) -> list[bytes]:
    """Words parted by ASCII white space; lower: A-Z become a-z, other letters stay."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


#: Bytes whose words are hashed at once.
_PIECE = 1 << 19
_IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for, which the longest word bounds."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int):
        if n > len(self.up):
            for name, x in (("up", int(_STEP)), ("down", pow(int(_STEP), -1, 1 << 64))):
                row = np.full(n, x, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (parted by ASCII white space), and each text's number of words.

    A word's hash is a polynomial over its bytes, read off running sums, so no word is made a Python object.
    """
    data = np.frombuffer(b" ".join([b"", *(t or b"" for t in texts), b""]), np.uint8)
    space = _IS_SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1  # starts and ends in turn: the first and last byte are space
    start, end = edges[::2], edges[1::2]
    bounds = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    counts = np.diff(np.searchsorted(start, bounds))
    out, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        low = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, low + _PIECE, "right")))
        up, down = _powers.upto(max(_PIECE, int(end[to - 1]) - low))
        part = data[low : int(end[to - 1])]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        a, b = start[at:to] - low, end[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        at = to
    return _mixed(out), counts


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def grams(w: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of k words, in order."""
    n = len(w) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = (h ^ w[i : i + n]) * _STEP
        h ^= h >> np.uint64(29)
    return _mixed(h)


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its k-word shingles; of fewer words, the whole sequence as one; of none, empty."""
    words, counts = hashed_words(texts)
    at = 0
    for n in counts.tolist():
        yield np.unique(grams(words[at : at + n], min(k, n))) if n else np.empty(0, np.uint64)
        at += n


def shingle_set(text: bytes, k: int) -> np.ndarray:
    return next(shingle_sets([text], k))


def enough(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def pack(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)
