"""Word shingles as 64-bit hashes, computed over whole Arrow batches with numpy.

Words are runs of characters other than ASCII white space, with A-Z in lower case;
a shingle is ``width`` consecutive words, or the whole sequence where a text has fewer.
Everything works on the UTF-8 bytes of a batch, without an object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that nearby values part."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A 64-bit value for each byte; those of A-Z are those of a-z.
_BYTE = _mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]
#: Powers of an odd number, the weight of a byte by its place in the word; extended when needed.
_BASE = 0xD6E8FEB86659FD93
_POWERS = np.ones(1, dtype=_U)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(max(n, 4096) - 1, _BASE, _U)]))
    return _POWERS


def blocks(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of rows of about ``most`` bytes; a row is never split."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block, and how many words each row has."""
    inside = ~_SPACE[data]
    if not inside.any():
        return np.empty(0, _U), np.zeros(len(offsets) - 1, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = inside[edges]  # a row's first byte starts a word whatever stands before
    starts = np.flatnonzero(first)
    # white space weighs nothing; its places are not looked up
    at = np.flatnonzero(inside)
    lengths = np.diff(np.searchsorted(at, np.append(starts, len(data))))
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(at), dtype=np.int64) - np.repeat(begins, lengths)
    weighed = _BYTE[data[at]]
    weighed *= _powers(int(lengths.max()))[place]
    hashes = _mixed(np.add.reduceat(weighed, begins))
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingle hashes of the rows one after another, set sizes)."""
    for at, data, offsets in blocks(texts):
        words, counts = word_hashes(data, offsets)
        ends = np.cumsum(counts)
        if len(words) >= width:
            rolled = np.zeros(len(words) - width + 1, _U)
            for k in range(width):
                rolled = (rolled ^ words[k : len(words) - width + 1 + k]) * _U(0x9E3779B97F4A7C15)
                rolled ^= rolled >> _U(29)
            rolled = _mixed(rolled)
        sets, sizes = [], np.zeros(len(counts), np.int64)
        for row, (n, end) in enumerate(zip(counts.tolist(), ends.tolist())):
            if n >= width:
                part = np.sort(rolled[end - n : end - width + 1])
                keep = np.empty(len(part), bool)
                keep[0] = True
                np.not_equal(part[1:], part[:-1], out=keep[1:])
                part = part[keep]
            elif n:
                whole = np.full(1, n, _U)
                for w in words[end - n : end]:
                    whole = _mixed((whole ^ w) * _U(0xD6E8FEB86659FD93))
                part = whole
            else:
                continue
            sets.append(part)
            sizes[row] = len(part)
        yield at, np.concatenate(sets) if sets else np.empty(0, _U), sizes
