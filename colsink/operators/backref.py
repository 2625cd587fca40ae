"""Back-references: a repeated text is written as the distance to where it stood last.

Items are numbered from 1 and every item counts, nulls too. The empty text, texts of one
ASCII character and null are always remembered; longer ones only as far as the memory
allows, in two generations of which the older is forgotten when the younger is full.
A distance below 64 takes one byte, 80 + distance; others 80 and groups of seven bits,
low first. The distance 0 stands for a null not seen yet. A batch starts afresh.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_MEMORY, MOST_MEMORY = 8192, 1 << 24
_ENTRY = 16  # bytes a remembered text takes besides its own
_NULL, _EMPTY = 128, 129  # codes of short items beside the ASCII ones


def memory_size(option: str) -> int:
    """Bytes of a size such as ``0``, ``64k`` or ``1M``; -1 turns back-references off."""
    m = re.fullmatch(r"\s*(-1|\d+)\s*([kKmM]?)\s*", option)
    if not m or m[1] == "-1" and m[2]:
        raise ValueError(f"not a size: {option!r}")
    return int(m[1]) << {"": 0, "k": 10, "m": 20}[m[2].lower()]


class Encoder:
    """Encodes one batch's items; ``memory`` 0 remembers only the shortest."""

    def __init__(self, memory: int = 0):
        self.most = min(max(memory, LEAST_MEMORY), MOST_MEMORY) if memory > 0 else 0
        self.number = 0
        self.short: dict[bytes | None, int] = {}
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}
        self.used = 0

    def _last(self, item: bytes | None) -> int | None:
        """Where the item stood last; it now stands here."""
        if item is None or not item or len(item) == 1 and item[0] < 128:
            last = self.short.get(item)
            self.short[item] = self.number
            return last
        if 3 * len(item) > self.most:
            return None
        last = self.young.get(item)
        if last is None:
            last = self.old.pop(item, None)
            self.used += len(item) + _ENTRY
            if 2 * self.used > self.most:
                self.old, self.young, self.used = self.young, {}, len(item) + _ENTRY
        self.young[item] = self.number
        return last

    def encode(self, items: Iterable[bytes | None]) -> bytes:
        """Bytes of the next items; may be called again for more of the same batch."""
        out = bytearray()
        for item in items:
            self.number += 1
            last = self._last(item)
            if last is not None:
                out += reference(self.number - last)
            elif item is None:
                out += b"\x80\x00"
            else:
                out += item
                out.append(0)
        return bytes(out)


    def encode_array(self, column: pa.Array) -> bytes:
        """As ``encode`` for an Arrow column of texts; without a loop where only the shortest are remembered."""
        big = column.cast(pa.large_binary())
        if self.most:
            return self.encode(big.to_pylist())
        n = len(big)
        if not n:
            return b""
        nulls = np.asarray(big.is_null())
        full = big.fill_null(b"")
        offsets = np.frombuffer(full.buffers()[1], "<i8")[full.offset : full.offset + n + 1]
        data = np.frombuffer(full.buffers()[2] or b"\x00", "u1")
        sizes = np.diff(offsets)
        heads = data[np.minimum(offsets[:-1], len(data) - 1)].astype(np.int64)
        code = np.where(nulls, _NULL, np.where(sizes == 0, _EMPTY, np.where((sizes == 1) & (heads < 128), heads, -1)))
        at = np.arange(self.number + 1, self.number + n + 1)
        self.number += n
        last = np.zeros(n, np.int64)
        short = np.flatnonzero(code >= 0)
        order = short[np.argsort(code[short], kind="stable")]
        same = np.zeros(len(order), bool)
        same[1:] = code[order[1:]] == code[order[:-1]]
        last[order[same]] = at[order[np.flatnonzero(same) - 1]]
        items = [None if c == _NULL else b"" if c == _EMPTY else bytes([c]) for c in range(_EMPTY + 1)]
        firsts = order[~same]
        last[firsts] = [self.short.get(items[c], 0) for c in code[firsts]]
        ends = order[np.flatnonzero(np.append(~same, True)[1:])] if len(order) else order
        self.short.update({items[c]: int(p) for c, p in zip(code[ends], at[ends])})
        distance = np.where(last > 0, at - last, 0)
        groups = sum((distance >= 1 << 7 * k).astype(np.int64) for k in range(1, 6)) + 1
        length = np.where(distance > 0, np.where(distance < 64, 1, 1 + groups), np.where(nulls, 2, sizes + 1))
        starts = np.cumsum(length) - length
        out = np.zeros(int(length.sum()), "u1")
        near = (distance > 0) & (distance < 64)
        out[starts[near]] = 128 + distance[near]
        out[starts[(distance >= 64) | (nulls & (distance == 0))]] = 128
        for k in range(6):
            more = (distance >= 64) & (groups > k)
            out[starts[more] + 1 + k] = (distance[more] >> 7 * k & 127) | np.where(groups[more] > k + 1, 128, 0)
        plain = np.flatnonzero((distance == 0) & ~nulls & (sizes > 0))
        lengths = sizes[plain]
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(starts[plain], lengths) + within] = data[np.repeat(offsets[plain], lengths) + within]
        return out.tobytes()


def reference(distance: int) -> bytes:
    """The bytes of a distance of 1 or more."""
    if distance < 64:
        return bytes([128 + distance])
    out = bytearray([128])
    while distance >= 128:
        out.append(distance & 127 | 128)
        distance >>= 7
    out.append(distance)
    return bytes(out)


def decode(data: bytes) -> list[bytes | None]:
    """The items of one batch; ValueError where a reference leads nowhere."""
    items: list[bytes | None] = []
    at = 0
    while at < len(data):
        head = data[at]
        if not 128 <= head < 192:
            end = data.find(b"\x00", at)
            if end < 0:
                raise ValueError("a text without its end")
            items.append(data[at:end])
            at = end + 1
            continue
        at += 1
        distance = head - 128
        if not distance:
            shift = 0
            while True:
                if at >= len(data):
                    raise ValueError("a distance without its end")
                distance |= (data[at] & 127) << shift
                shift += 7
                at += 1
                if data[at - 1] < 128:
                    break
            if not distance:
                items.append(None)
                continue
        if distance > len(items):
            raise ValueError(f"item {len(items) + 1} refers {distance} back")
        items.append(items[-distance])
    return items


def distances(df: DataFrame, value: str, batch: list[str], order: list[str], into: str = "distance") -> DataFrame:
    """The distance of each item to its last equal in its batch, null for the first, by windows.

    The unbounded form: every text is remembered. Items of a batch are numbered in one
    window, so batches should be of bounded size.
    """
    by = [F.col(c) for c in order]
    item = F.row_number().over(Window.partitionBy(*batch).orderBy(*by))
    numbered = df.withColumn("_item", item)
    last = F.lag("_item").over(Window.partitionBy(*batch, value).orderBy("_item"))
    return numbered.withColumn(into, F.col("_item") - last).drop("_item")


def is_short(value: Column) -> Column:
    """Null, empty or one ASCII character: remembered at any memory size."""
    return value.isNull() | (F.octet_length(value) <= 1)
