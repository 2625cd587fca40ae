"""Cropped and edited copies among images, by local descriptors.

Features: corners (the Harris response, largest within a radius) at scales ``octave`` of
which make a factor of two; a corner's orientation is the direction of its patch's intensity centroid;
128 binary tests between smoothed pixels, turned by that orientation, make a descriptor.

Candidates: four words of ``word_bits`` each cover a descriptor (beyond 32 neighbours overlap), and equal words
meet in a hash table, one for each place. Images that are equal bit for bit are one class, linked with its smallest id without a
look at corners. Two classes are compared if they share ``least_votes`` words at least and ``least_words``
of the words of the one that has fewer. That is found in two rounds, so that many images with common words
don't make all their pairs:

* Each word's images are compared with one centre, the image of fewest words among them.
* Those that share words and are still in different components are joined by prefixes: of an image's
  words, ordered from rare to common, so many of the most common ones are left out that a pair with
  enough words in common has half of those still among the others. What a crowd of images has
  in common and is a small part of each meets nobody there; what is a large part of them has linked
  them with the centre already. The filter loses no pair.

Confirmation: pairs of which fewer corners match than a copy needs are left out first, by the descriptors alone;
this loses no link. Each corner of the image with fewer of them is then matched with all corners of
the other that are nearest by Hamming distance; each match proposes a scale, a turn and a
shift. The proposals that most corners agree in are refined to a similarity by least squares, and the
corners that follow it are counted. An edit may shift what follows it, so shifts of the same
scale and turn may add up. A pair is linked where enough of the smaller image's corners
agree. Linked images form components.

Defined cases: null, empty or malformed images have no corners, and equal ones aren't
copies of each other; images with too few corners are copies of equal images only. Long
images are handled whole. Repeated rows and ties are copies. An empty table gives an empty result.
Only the key and the image are read, so other columns' names can't clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colsink.llm.common import Scratch, read_table
from colsink.llm.near_dup import components
from colsink.llm.tokenizing import small_batches

RADIUS = 7  # of a patch
TURNS = 36  # a quarter turn is a whole number of them
BITS = 128


@dataclass(frozen=True)
class Copies:
    """``scales``, of which ``octave`` make a factor of two; ``apart``: radius within which a corner is the strongest;
    ``word_bits``: 32 to 60, of a word in a hash table; short words outlast noise, but the more corners a table of
    images has and the flatter its patches, the more of them meet by chance;
    ``least_votes`` words and ``least_words`` of an image's words make a candidate; ``most_bits``: of a match's
    difference; ``shift``: pixels within which corners agree; ``least_agreeing`` corners and ``least_share`` of
    the smaller image's make a copy."""

    scales: int = 7
    octave: int = 3
    apart: int = 5
    word_bits: int = 32
    least_votes: int = 2
    least_words: float = 0.02
    most_bits: int = 24
    shift: int = 12
    least_agreeing: int = 6
    least_share: float = 0.3


def to_pgm(pixels: np.ndarray) -> bytes:
    """Binary grey map of an array of bytes."""
    h, w = pixels.shape
    return b"P5 %d %d 255\n" % (w, h) + np.ascontiguousarray(pixels, np.uint8).tobytes()


_PGM = re.compile(rb"P5(?:\s+#[^\n]*)*\s+(\d+)\s+(\d+)\s+(\d+)\s")


def from_pgm(data: bytes | None) -> np.ndarray | None:
    """Pixels of a binary grey map of 8 or 16 bits, scaled to 255, or None where it is none."""
    m = _PGM.match(data or b"")
    w, h, top = (int(m[1]), int(m[2]), int(m[3])) if m else (0, 0, 0)
    kind = np.dtype(">u2" if top > 255 else "u1")
    if not w or not h or not 0 < top < 1 << 16 or len(data) - m.end() < w * h * kind.itemsize:
        return None
    pixels = np.frombuffer(data, kind, w * h, m.end()).reshape(h, w)
    return pixels if top == 255 else pixels.astype("f4") * np.float32(255 / top)


def _tests() -> np.ndarray:
    """Offsets of the tests for each turn: (turn, end, test) pairs of y and x, within the patch."""
    rng = np.random.default_rng(911)
    ends = np.clip(rng.normal(0, RADIUS / 2.2, (2, BITS, 2)), 1 - RADIUS, RADIUS - 1)
    out = np.empty((TURNS, 2, BITS, 2), np.int64)
    for k in range(TURNS):
        a = 2 * np.pi * k / TURNS
        y, x = ends[..., 0], ends[..., 1]
        out[k, ..., 0] = np.clip(np.rint(np.sin(a) * x + np.cos(a) * y), -RADIUS, RADIUS)
        out[k, ..., 1] = np.clip(np.rint(np.cos(a) * x - np.sin(a) * y), -RADIUS, RADIUS)
    return out


_TESTS = _tests()
_GRID = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
_DISC = (_GRID[0] ** 2 + _GRID[1] ** 2) <= RADIUS**2


def _summed(a: np.ndarray, r: int) -> np.ndarray:
    """Sums over squares of side 2 r + 1, nothing beyond the edges."""
    for axis in (0, 1):
        out = a.copy()
        n = a.shape[axis]
        for d in range(1, min(r, n - 1) + 1):
            lo, hi = (slice(None),) * axis + (slice(0, n - d),), (slice(None),) * axis + (slice(d, n),)
            out[lo] += a[hi]
            out[hi] += a[lo]
        a = out
    return a


def _largest(a: np.ndarray, r: int) -> np.ndarray:
    """Maxima over squares of side 2 r + 1."""
    for axis in (0, 1):
        n, reach, out = a.shape[axis], 0, a
        while reach < r:
            step = min(reach + 1, r - reach) if reach else 1
            step = min(step, max(1, n - 1))
            now = out.copy()
            lo, hi = (slice(None),) * axis + (slice(0, n - step),), (slice(None),) * axis + (slice(step, n),)
            np.maximum(now[lo], out[hi], out=now[lo])
            np.maximum(now[hi], out[lo], out=now[hi])
            out, reach = now, reach + step
        a = out
    return a


def _corners(stack: np.ndarray, live: np.ndarray, how: Copies) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(y, x, turn, packed bits) of a stack's corners; ``live`` tells whose patch is inside an image."""
    if min(stack.shape) <= 2 * RADIUS:
        return (np.empty(0, np.int64),) * 3 + (np.empty((0, BITS // 8), np.uint8),)
    smooth = _summed(stack, 1)
    gy, gx = np.zeros_like(smooth), np.zeros_like(smooth)
    gy[1:-1] = smooth[2:] - smooth[:-2]
    gx[:, 1:-1] = smooth[:, 2:] - smooth[:, :-2]
    xx, yy, xy = _summed(gx * gx, 2), _summed(gy * gy, 2), _summed(gx * gy, 2)
    response = xx * yy - xy * xy - np.float32(0.05) * (xx + yy) ** 2
    strongest = (response == _largest(response, how.apart)) & (response > 0) & live
    y, x = np.nonzero(strongest)
    width = stack.shape[1]
    flat, at = smooth.ravel(), y * width + x
    offsets = (_GRID[0] * width + _GRID[1])[_DISC]
    turn, bits = np.empty(len(at), np.int64), np.empty((len(at), BITS // 8), np.uint8)
    tests = _TESTS[..., 0] * width + _TESTS[..., 1]
    for s in range(0, len(at), 4096):
        part = at[s : s + 4096]
        patch = flat[part[:, None] + offsets]
        my, mx = patch @ _GRID[0][_DISC].astype("f4"), patch @ _GRID[1][_DISC].astype("f4")
        k = np.rint(np.arctan2(my, mx) * TURNS / (2 * np.pi)).astype(np.int64) % TURNS
        turn[s : s + 4096] = k
        chosen = tests[k]
        bits[s : s + 4096] = np.packbits(flat[part[:, None] + chosen[:, 0]] < flat[part[:, None] + chosen[:, 1]], axis=1)
    return y, x, turn, bits


def resized(m: np.ndarray, factor: float) -> np.ndarray:
    """A picture at a smaller size, between its pixels in a straight line."""
    ats = []
    for n in m.shape:
        size = max(1, round(n * factor))
        at = np.clip((np.arange(size) + 0.5) / factor - 0.5, 0, n - 1)
        low = np.minimum(at.astype(np.int64), max(n - 2, 0))
        ats.append((low, np.minimum(low + 1, n - 1), (at - low).astype("f4")))
    (y, y1, fy), (x, x1, fx) = ats
    rows = m[y] * (1 - fy[:, None]) + m[y1] * fy[:, None]
    return rows[:, x] * (1 - fx) + rows[:, x1] * fx


@dataclass
class Features:
    """An image's corners: place in full-size pixels, scale, turn and descriptor words."""

    y: np.ndarray
    x: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    words: np.ndarray


def features(images: list[np.ndarray | None], how: Copies) -> list[Features]:
    """Of each image; images of one width are laid below each other and handled together."""
    out: list[list] = [[] for _ in images]
    by_width: dict[int, list[int]] = {}
    for i, m in enumerate(images):
        if m is not None:
            by_width.setdefault(m.shape[1], []).append(i)
    for group in by_width.values():
        at = 0
        while at < len(group):
            rows, to = 0, at
            while to < len(group) and (to == at or rows * images[group[at]].shape[1] < 400_000):
                rows += images[group[to]].shape[0]
                to += 1
            whole = [images[i].astype("f4") for i in group[at:to]]
            for scale in range(how.scales):
                octave, step = divmod(scale, how.octave)
                if octave and not step:
                    whole = [m[: m.shape[0] // 2 * 2, : m.shape[1] // 2 * 2].reshape(m.shape[0] // 2, 2, m.shape[1] // 2, 2).mean(axis=(1, 3)) for m in whole]
                if whole[0].shape[1] <= 2 * RADIUS:
                    break
                factor = 2.0 ** (-step / how.octave)
                part = [resized(m, factor) for m in whole] if step else whole
                back = 2.0 ** (scale / how.octave)
                heights = np.array([m.shape[0] for m in part])
                starts = np.concatenate([[0], np.cumsum(heights)])
                stack = np.concatenate(part)
                live = np.zeros(stack.shape, bool)
                for s, h in zip(starts.tolist(), heights.tolist()):
                    live[s + RADIUS + 1 : max(s, s + h - RADIUS - 1), RADIUS + 1 : stack.shape[1] - RADIUS - 1] = True
                y, x, turn, bits = _corners(stack, live, how)
                words = bits.view(">u8").astype(np.uint64)
                which = np.searchsorted(starts, y, side="right") - 1
                cuts = np.searchsorted(which, np.arange(len(part) + 1))
                for k, i in enumerate(group[at:to]):
                    a, b = cuts[k], cuts[k + 1]
                    if b > a:
                        out[i].append((np.rint((y[a:b] - starts[k]) * back).astype(np.int64), np.rint(x[a:b] * back).astype(np.int64), np.full(b - a, scale), turn[a:b], words[a:b]))
            at = to
    none = (np.empty(0, np.int64),) * 4 + (np.empty((0, BITS // 64), np.uint64),)
    return [Features(*(np.concatenate(c) for c in zip(*f))) if f else Features(*none) for f in out]


def _nearest(a: Features, b: Features, how: Copies) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(corners of a, corners of b) nearest to them, ties included, in blocks of ``a`` for long images."""
    step, part = max(1, 1_000_000 // len(b.y)), max(1, 60_000 // len(b.y))
    columns = [np.ascontiguousarray(b.words[:, w]) for w in range(BITS // 64)]
    for s in range(0, len(a.y), step):
        found = []
        for r in range(s, min(s + step, len(a.y)), part):  # what a processor's cache holds
            words = a.words[r : min(r + part, s + step)]
            bits = sum(np.bitwise_count(words[:, w, None] ^ column) for w, column in enumerate(columns))
            least = bits.min(axis=1)
            near = np.flatnonzero(least <= how.most_bits)
            i, j = np.divmod(np.flatnonzero(bits[near] == least[near, None]), len(b.y))
            found.append((near[i] + r, j))
        yield tuple(np.concatenate(c) for c in zip(*found))


def _bounded(blocks: Iterator[tuple[np.ndarray, np.ndarray]], most: int = 500_000) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """All blocks of matches, or None where they are too many to keep and must be matched again for each pass."""
    kept, size = [], 0
    for block in blocks:
        kept.append(block)
        size += len(block[0])
        if size > most:
            return None
    return [tuple(np.concatenate(c) for c in zip(*kept))]


def _distinct(key: np.ndarray, corner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, in order."""
    if len(key):
        # in as many bits as the fields span, a pair is one number
        low = (1 << 25) - 1
        fields = [key >> 50, key >> 25 & low, key & low, corner]
        least = [int(f.min()) for f in fields]
        widths = [(int(f.max()) - lo).bit_length() for f, lo in zip(fields, least)]
        if sum(widths) < 63:
            both = fields[0] - least[0]
            for f, lo, width in zip(fields[1:], least[1:], widths[1:]):
                both = both << width | (f - lo)
            both.sort()
            both = both[np.concatenate([[True], both[1:] != both[:-1]])]
            out = []
            for lo, width in zip(least[::-1], widths[::-1]):
                out.append((both & ((1 << width) - 1)) + lo)
                both = both >> width
            return (out[3] << 50) + (out[2] << 25) + out[1], out[0]
    order = np.lexsort((corner, key))
    key, corner = key[order], corner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (corner[1:] != corner[:-1])
    return key[new], corner[new]


def _cells(shift: np.ndarray, size: float, half: int) -> np.ndarray:
    """Cells of one of two staggered grids, so that a cluster isn't cut by both."""
    y = np.floor(shift.imag / size + half / 2).astype(np.int64)
    x = np.floor(shift.real / size + half / 2).astype(np.int64)
    return (y + (1 << 24) << 25) + (x + (1 << 24))


def agreeing(a: Features, b: Features, how: Copies, least: float = 0) -> int:
    """Corners of ``a`` whose nearest matches in ``b`` agree on scale, turn and shift.

    Where ``least`` is given, the count may stop once it is reached, and is 0 if fewer match at all.
    """
    if not len(a.y) or not len(b.y):
        return 0
    za, zb = a.x + 1j * a.y, b.x + 1j * b.y
    middle = (za.real.max() + za.real.min()) / 2 + 1j * (za.imag.max() + za.imag.min()) / 2
    za, reach = za - middle, float(np.abs(za - middle).max())
    kept = _bounded(_nearest(a, b, how))
    pose = lambda i, j: (b.scale[j] - a.scale[i], (b.turn[j] - a.turn[i]) % TURNS)
    posed = [(i, j, *pose(i, j)) for i, j in kept] if kept is not None else None
    matches = lambda: posed if posed is not None else ((i, j, *pose(i, j)) for i, j in _nearest(a, b, how))
    if sum(len(np.unique(i)) for i, *_ in matches()) < max(least, 3):
        return 0

    # no pose within the bounds of the last count has enough matches
    if least:
        by_pose = np.zeros((65, TURNS), np.int64)
        for _, _, ratio, turn in matches():
            by_pose += np.bincount((ratio + 32) * TURNS + turn, minlength=by_pose.size).reshape(by_pose.shape)
        by_pose = sum(np.roll(by_pose, k, axis=1) for k in range(-2, 3))
        if (by_pose + np.roll(by_pose, 1, axis=0) + np.roll(by_pose, -1, axis=0)).max() < least:
            return 0

    # windows of two turns, and of two scales where these lie close, count the corners of coarse shifts
    grows = 2.0 ** ((np.arange(-33, 33) + (how.octave > 1) / 2) / how.octave)
    turned = np.exp(2j * np.pi * (np.arange(TURNS) + 0.5) / TURNS)
    linears, sizes = grows[:, None] * turned, np.maximum(2 * how.shift, 0.25 * grows * reach)

    def proposed() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for i, j, ratio, turn in matches():
            from_a, from_b = za[i], zb[j]
            for lower in (0, 1):
                for less in (0, 1) if how.octave > 1 else (0,):
                    k, r = (turn - lower) % TURNS, ratio - less
                    shift, size = from_b - linears[r + 33, k] * from_a, sizes[r + 33]
                    for half in (0, 1):
                        yield ((r + 32) * TURNS + k << 51) + (half << 50) + _cells(shift, size, half), i, j

    told = list(proposed()) if kept is not None else None
    offered = lambda: told if told is not None else proposed()
    names, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for key, i, _ in offered():
        new, more = np.unique(_distinct(key, i)[0], return_counts=True)
        names, at = np.unique(np.concatenate([names, new]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, more]), len(names)).astype(np.int64)

    def places(name: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for key, i, j in offered():
            mine = np.flatnonzero(key == name)
            yield za[i[mine]], zb[j[mine]]

    most = 0
    for name in names[np.lexsort((names, -counts))[:3]]:
        if least and most >= least:
            break
        # least squares over the proposal's matches, then over those near its result
        linear, shift, within = None, 0j, np.inf
        chosen = list(places(name)) if told is not None else None
        for within in (np.inf, 4 * how.shift, 2 * how.shift):
            n, sums = 0, np.zeros(4, complex)
            for p, q in chosen if chosen is not None else places(name):
                if linear is not None:
                    close = np.abs(q - linear * p - shift) <= within
                    p, q = p[close], q[close]
                n += len(p)
                sums += p.sum(), q.sum(), (q * p.conj()).sum(), (p * p.conj()).sum()
            spread = sums[3] - sums[0] * sums[0].conjugate() / max(n, 1)
            if n < 3 or abs(spread) < 1e-6:
                break
            linear = (sums[2] - sums[1] * sums[0].conjugate() / n) / spread
            shift = (sums[1] - linear * sums[0]) / n
        if linear is None or abs(linear) < 1e-3:
            continue
        angle, grown = np.angle(linear) * TURNS / (2 * np.pi), np.log2(abs(linear)) * how.octave
        fitting: list[tuple[np.ndarray, np.ndarray]] = []
        for i, j, ratio, turn in matches():
            fits = np.flatnonzero((np.abs(ratio - grown) <= 1) & (np.abs((turn - angle + TURNS / 2) % TURNS - TURNS / 2) <= 2))
            fitting.append((zb[j[fits]] - linear * za[i[fits]], i[fits]))
        for half in (0, 1):
            found = [_distinct(_cells(rest, how.shift, half), i) for rest, i in fitting]
            key, corner = (np.concatenate(c) for c in zip(*found))
            cells, at, each = np.unique(key, return_inverse=True, return_counts=True)
            most = max(most, len(np.unique(corner[each[at] >= 3])))
    return most


# places travel as one number each
_FIELDS = ((35, 28), (11, 24), (6, 5), (0, 6))  # shift and width of y, x, scale and turn


def _packed(f: Features) -> np.ndarray:
    return f.y << 35 | f.x << 11 | f.scale << 6 | f.turn


def _unpacked(place: np.ndarray, words: np.ndarray) -> Features:
    parts = [place >> shift & ((1 << width) - 1) for shift, width in _FIELDS]
    return Features(*parts, words.view(np.uint64).reshape(-1, BITS // 64))


def described(images: DataFrame, how: Copies, key: str, image: str) -> DataFrame:
    """(id, name, n, place, words) of each image; ``name`` is a digest of its bytes, null for no image.

    An image wider than 2^24 pixels or higher than 2^28 has a name, so that equal ones are copies, and no corners.
    """
    small_batches(images, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            pixels = [from_pgm(r) for r in raw]
            names = [hashlib.blake2b(r, digest_size=16).digest() if m is not None else None for r, m in zip(raw, pixels)]
            found = features([m if m is not None and m.shape[1] < 1 << 24 and m.shape[0] < 1 << 28 else None for m in pixels], how)
            offsets = np.concatenate([[0], np.cumsum([len(f.y) for f in found])]).astype(np.int32)
            place = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([_packed(f) for f in found])))
            words = pa.ListArray.from_arrays(pa.array(offsets * (BITS // 64)), pa.array(np.concatenate([f.words.ravel().view(np.int64) for f in found])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), pa.array(np.diff(offsets), pa.int32()), place, words], names=["id", "name", "n", "place", "words"])

    narrow = images.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{image}`").cast("binary").alias("image"))
    return narrow.mapInArrow(run, "id long, name binary, n int, place array<long>, words array<long>")


def _least(n: int, how: Copies) -> float:
    """Corners that must agree, of the ``n`` that the smaller image has."""
    return max(how.least_agreeing, how.least_share * n)


def _met(few: np.ndarray, many: np.ndarray, how: Copies) -> int:
    """How many of the descriptors ``few`` differ from one of ``many`` in ``most_bits`` at most; in blocks for long images."""
    least = np.full(len(few), BITS, np.uint8)
    columns = [np.ascontiguousarray(few[:, w]) for w in range(BITS // 64)]
    step = max(1, 60_000 // max(1, len(few)))
    for s in range(0, len(many), step):
        bits = sum(np.bitwise_count(many[s : s + step, w, None] ^ column) for w, column in enumerate(columns))
        np.minimum(least, bits.min(axis=0), out=least)
    return int((least <= how.most_bits).sum())


def _first_halves(few: np.ndarray, many: np.ndarray, how: Copies) -> np.ndarray:
    """Which of the half descriptors ``few`` differ from one of ``many`` in ``most_bits`` at most."""
    least = np.full(len(few), 64, np.uint8)
    step = max(1, 60_000 // max(1, len(few)))
    for s in range(0, len(many), step):
        np.minimum(least, np.bitwise_count(many[s : s + step, None] ^ few).min(axis=0), out=least)
    return least <= how.most_bits


def possible(b: np.ndarray, p: tuple[np.ndarray, np.ndarray], q: tuple[np.ndarray, np.ndarray], how: Copies) -> np.ndarray:
    """Which of these pairs have as many corners that match as a copy needs.

    ``p`` and ``q`` are both sides' descriptors, and the places where each pair's begin and the last one's end;
    ``b`` names the q side. Next to each other, pairs of one ``b`` are compared together by halves of descriptors
    first: where these differ too much, the whole ones do.
    """
    (pw, ps), (qw, qs) = p, q
    keep = np.zeros(len(b), bool)
    runs = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, int)
    half_p, half_q = np.ascontiguousarray(pw[:, 0]), np.ascontiguousarray(qw[:, 0])
    for r, to in zip(runs[:-1].tolist(), runs[1:].tolist()):
        many = qw[qs[r] : qs[r + 1]]
        at, sizes = ps[r : to + 1] - ps[r], np.diff(ps[r : to + 1])
        need = np.maximum(3, [_least(n, how) for n in np.minimum(sizes, len(many)).tolist()])
        total = np.concatenate([[0], np.cumsum(_first_halves(half_p[ps[r] : ps[to]], half_q[qs[r] : qs[r + 1]], how))])
        # of a larger p side this isn't the count that decides
        for i in np.flatnonzero((total[at[1:]] - total[at[:-1]] >= need) | (sizes > len(many))).tolist():
            one = pw[ps[r + i] : ps[r + i + 1]]
            few, more = (one, many) if len(one) <= len(many) else (many, one)
            keep[r + i] = _met(few, more, how) >= need[i]
    return keep


def _confirmed(pairs: DataFrame, classes: DataFrame, how: Copies) -> DataFrame:
    """(a, b) of pairs that are copies by their corners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for side in "pq":
                starts = np.asarray(batch.column(f"{side}_place").offsets).astype(np.int64)
                words = np.asarray(batch.column(f"{side}_words").flatten()).view(np.uint64).reshape(-1, BITS // 64)
                sides.append((np.asarray(batch.column(f"{side}_place").flatten()), words, starts - starts[0]))
            keep = possible(np.asarray(batch.column("b")), *((words, starts) for _, words, starts in sides), how)
            for k in np.flatnonzero(keep).tolist():
                p, q = (_unpacked(place[starts[k] : starts[k + 1]], words[starts[k] : starts[k + 1]]) for place, words, starts in sides)
                p, q = (p, q) if len(p.y) <= len(q.y) else (q, p)
                least = _least(len(p.y), how)
                keep[k] = agreeing(p, q, how, least) >= least
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    def side(name: str, to: str) -> DataFrame:
        return classes.select(F.col("id").alias(to), F.col("place").alias(f"{name}_place"), F.col("words").alias(f"{name}_words"))

    both = pairs.join(side("p", "a"), "a").join(side("q", "b"), "b").select("a", "b", "p_place", "p_words", "q_place", "q_words")
    return both.mapInArrow(run, "a long, b long").distinct()


def find_copies(images: DataFrame, how: Copies = Copies(), key: str = "id", image: str = "image") -> DataFrame:
    """(id, n_corners, component_id): one row for each row of ``images`` (key, binary grey map).

    ``component_id`` is the smallest id among copies. A null id stays apart.
    """
    scratch = Scratch(images.sparkSession, "images")
    every = scratch.keep(described(images, how, key, image), "described")

    # the smallest id stands for its class of equal images; features are kept of these alone
    listed = scratch.keep(every.select("id", "name", "n"), "listed")
    named = listed.where("name IS NOT NULL AND id IS NOT NULL").select("name", "id")
    least = scratch.keep(named.distinct().groupBy("name").agg(F.min("id").alias("b"), F.max("id").alias("top")), "classes")
    equal = named.join(least.where("b < top"), "name").where("id != b").select(F.col("id").alias("a"), "b")
    classes = every.where(F.col("n") >= how.least_agreeing).join(least.select("name", F.col("b").alias("id")), ["name", "id"], "left_semi")
    classes = scratch.keep(classes.dropDuplicates(["id", "name"]).select("id", "place", "words"), "features")
    scratch.drop("described")

    # words that more than one class has, with their classes; an image's own words are told apart in its row
    def cut(word: Column, at: Column) -> Column:
        table = (at % (BITS // 64)).cast("long") * 2
        partner = F.get("words", at.bitwiseXOR(F.lit(1)))
        more = how.word_bits - 32
        across = F.shiftleft(word.bitwiseAND(0xFFFFFFFF), more).bitwiseOR(F.shiftrightunsigned(F.shiftrightunsigned(partner, 32), 32 - more))
        return F.array(table * 2**how.word_bits + F.shiftrightunsigned(word, 32 - more), (table + 1) * 2**how.word_bits + across)

    own = classes.select("id", F.array_distinct(F.flatten(F.transform("words", cut))).alias("keys"))
    held = own.select("id", F.size("keys").cast("int").alias("n"), F.explode("keys").alias("key"))
    images_of = F.count(F.lit(1)).over(Window.partitionBy("key")).cast("int")
    shared = scratch.keep(held.withColumn("f", images_of).where("f > 1"), "shared")

    def least_of(n: Column) -> Column:
        """Words that a pair must share, from the smaller one's number."""
        return F.greatest(F.lit(how.least_votes), F.ceil(n * how.least_words)).cast("long")

    # first with a word's centre
    centres = shared.groupBy("key").agg(F.min(F.struct("n", "id")).alias("c")).select("key", F.col("c.id").alias("b"), F.col("c.n").alias("m"))
    first = shared.join(centres, "key").where("id != b").groupBy(F.col("id").alias("a"), "b").agg(F.count(F.lit(1)).alias("votes"), F.min(F.least("n", "m")).alias("n"))
    first = scratch.keep(first.where(F.col("votes") >= least_of(F.col("n"))).select("a", "b"), "first-pairs")
    links = scratch.keep(_confirmed(first, classes, how), "first")
    scratch.drop("first-pairs")
    labels = components(links, scratch, "first-groups")

    # then what is still apart, by prefixes of the image that has fewer words; its words are put in order in one row
    rows = shared.groupBy("id").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("f", "key")))["key"].alias("keys"))
    apart = rows.join(labels, "id", "left").select("id", "n", F.coalesce("component", "id").alias("c"), "keys")
    apart = scratch.keep(apart, "apart")
    scratch.drop("shared")
    need = least_of(F.col("n"))
    half = F.ceil(need / 2)
    prefix = F.slice("keys", F.lit(1), (F.size("keys") - need + half).cast("int"))
    p = apart.where(F.size("keys") >= need).select("id", "n", "c", half.alias("half"), F.explode(prefix).alias("key")).alias("p")
    q = apart.select("id", "n", "c", F.explode("keys").alias("key")).alias("q")
    on = (F.col("p.key") == F.col("q.key")) & (F.col("p.c") != F.col("q.c")) & (F.struct("p.n", "p.id") < F.struct("q.n", "q.id"))
    met = p.join(q, on).groupBy(F.col("p.id").alias("a"), F.col("q.id").alias("b")).agg(F.count(F.lit(1)).alias("votes"), F.min("p.half").alias("half"))
    rest = scratch.keep(met.where("votes >= half").select("a", "b"), "rest-pairs")
    scratch.drop("apart")
    more = scratch.keep(_confirmed(rest, classes, how), "rest")
    scratch.drop("rest-pairs")

    groups = components(links.union(more).union(equal), scratch, "copies")
    out = listed.select("id", "n").join(groups, "id", "left")
    return out.select("id", F.col("n").alias("n_corners"), F.coalesce("component", "id").alias("component_id"))


# pictures of pages

#: Ink of a character by a fixed rule; a space has none.
_INK = ((np.arange(256) * 97) % 191 + 64).astype(np.uint8)
_INK[[9, 10, 11, 12, 13, 32]] = 0
COLUMNS = 64
#: Pages keep their pixels when they are copied: scales a factor of two apart do, long words, a twentieth of them, and matches of 16 bits.
PAGES = Copies(scales=3, octave=1, word_bits=48, least_words=0.05, most_bits=16)


def page_picture(html: str | None) -> bytes | None:
    """A picture of a whole page: a pixel for each byte, a blank row below each line."""
    if not html:
        return None
    data = html.encode()
    rows = -(-len(data) // COLUMNS)
    pixels = np.zeros((2 * rows, COLUMNS), np.uint8)
    line = np.zeros(rows * COLUMNS, np.uint8)
    line[: len(data)] = _INK[np.frombuffer(data, np.uint8)]
    pixels[::2] = line.reshape(rows, COLUMNS)
    return to_pgm(pixels)


def pictured(html: Column) -> Column:
    """Pictures of pages; null where there is no byte."""

    def run(pages: pa.Array) -> pa.Array:
        return pa.array([page_picture(p.as_py()) for p in pages], pa.binary())

    return F.arrow_udf(run, "binary")(html)


def op1_image_copies(spark, sf_dir: str) -> DataFrame:
    """Copies among pictures of all ``pages``."""
    pages = read_table(spark, sf_dir, "pages")
    small_batches(pages, 256)
    out = find_copies(pages.select("page_id", pictured(pages["html"].cast("string")).alias("image")), PAGES, key="page_id")
    return out.withColumnRenamed("id", "page_id")
