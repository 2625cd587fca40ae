"""Compression of column files: none, or LZ4 frames at a level."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa


@dataclass(frozen=True)
class Compression:
    """``level`` None: none is wanted; 0: fast; 1 to 17: high compression."""

    level: int | None = None

    @staticmethod
    def parse(option: str) -> Compression:
        m = re.fullmatch(r"(?i)none|lz4(?::(\d+))?", option.strip())
        if not m or m[1] and int(m[1]) > 17:
            raise ValueError(f"unknown compression {option!r}; use none, lz4 or lz4:0 to lz4:17")
        return Compression(None if option.strip().lower() == "none" else int(m[1] or 0))

    @property
    def suffix(self) -> str:
        return "" if self.level is None else ".lz4"

    def frame(self, data: bytes) -> bytes:
        """One complete frame; frames may follow each other in a file."""
        if self.level is None:
            return data
        codec = pa.Codec("lz4", compression_level=self.level) if self.level else pa.Codec("lz4")
        return codec.compress(data, asbytes=True)


def unframed(data: bytes) -> bytes:
    """All frames of a compressed file."""
    with pa.CompressedInputStream(pa.BufferReader(data), "lz4") as stream:
        return stream.read()
