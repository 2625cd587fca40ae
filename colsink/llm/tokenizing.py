"""Token ids of whole texts with a public tokenizer, a cache of pieces in front of it.

A text is cut where no token can cross, so that the pieces' ids one after another are
the text's ids. A vocabulary with word ends drops white space: its pieces are the words,
in lower case where the text is ASCII. In a byte-level vocabulary a piece begins before
a space or line feed that stands alone between other characters, as the pre-tokenizer
never joins such a character to what stands before it. Pieces repeat and are encoded
once per worker while its cache has room; any text with other white space or control
characters that could break these rules is encoded whole.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
END_ID = 0

_CUT = "\x00"
#: What Python's split takes for white space and the tokenizers don't.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: White space beside a space or line feed, all other white space, and the mark of cuts.
_RUNS = ("  ", " \n", "\n ", "\n\n", _CUT, "\t", "\r", "\x0b", "\x0c", *_NOT_SPACE)
_WIDE = ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")


_LATIN_END = "\u0250"  # letters before it compose and change case alike in all Unicode versions
_MARKS = ",.#*$%&"  # a run of them after a letter is apart from it
_DOTTED = "\u0130"  # but this one, whose lower case ends in a mark that is no letter


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids; special tokens are ordinary text.

    New pieces are encoded many at a time, a control character between them that no
    token joins to anything; its id tells where pieces end. Both vocabularies part a letter
    from punctuation, so full stops, commas and other marks after a Latin letter are split off first.
    """

    def __init__(self, path: str, most_pieces: int = 900_000, longest: int = 48):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.most_pieces, self.longest = most_pieces, longest
        # a vocabulary with word ends needs white space beside the mark
        self.words = any(x.endswith("</w>") for x in self.tokenizer.get_vocab())
        self.between = " \x01 " if self.words else "\x01"
        mark = self.tokenizer.encode("\x01", add_special_tokens=False).ids
        apart = sum("\u0101" in x for x in self.tokenizer.get_vocab()) <= 2  # the mark's byte occurs in no longer token
        self.mark = mark[0] if len(mark) == 1 and apart else None
        self.cache: dict[str, bytes] = {}

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        return [array("I", made.ids).tobytes() for made in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        if self.mark is None:
            return self._whole(pieces)
        out: list[bytes] = []
        for at in range(0, len(pieces), 512):
            part = pieces[at : at + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([self.between.join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(part) - 1:
                out += self._whole(part)
                continue
            packed, first = ids.tobytes(), 0
            for end in [*(ends * 4).tolist(), len(packed)]:
                out.append(packed[first:end])
                first = end + 4
        return out

    def _cut(self, t: str) -> list[str] | None:
        """The pieces of a text, or None where it must be encoded whole."""
        ascii_only = t.isascii()
        if self.words:
            return None if any(c in t for c in _NOT_SPACE) else (t.lower() if ascii_only else t).split()
        if any(c in t for c in _RUNS) or not ascii_only and any(c in t for c in _WIDE):
            return None
        return t.replace(" ", "\x00 ").replace("\n", "\x00\n").split(_CUT)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        cache = self.cache
        known = cache.get
        found: list[list] = []
        gaps: list[tuple[list, list[int], list[str]]] = []
        unsafe, missing = {}, set()
        for i, t in enumerate(texts):
            pieces = self._cut(t)
            if pieces is None:
                unsafe[i] = t
                found.append([])
                continue
            ids = list(map(known, pieces))
            at = [k for k, x in enumerate(ids) if x is None]
            if at:
                names = [pieces[k] for k in at]
                missing.update(names)
                gaps.append((ids, at, names))
            found.append(ids)
        stems = {}
        for p in missing:
            if p[-1:] in _MARKS:
                stem = p.rstrip(_MARKS)
                if len(stem) > 1 and stem[-1].isalpha() and stem[-1] < _LATIN_END and stem[-1] != _DOTTED:
                    stems[p] = stem
        parts = set(stems.values())
        parts.update(p[len(stem) :] for p, stem in stems.items())
        plain = (missing - stems.keys()) | parts.difference(cache)
        # the mark and an apostrophe after it would be one run, and the apostrophe's contraction lost
        long = [p for p in plain if len(p) > self.longest or p[:1] == "'" and not self.words]
        fresh = list(plain.difference(long))
        new = dict(zip(fresh, self._pieces(fresh)))
        new.update(zip(long, self._whole(long)))
        for p, stem in stems.items():
            tail = p[len(stem) :]
            new[p] = (new[stem] if stem in new else cache[stem]) + (new[tail] if tail in new else cache[tail])
        for ids, at, names in gaps:
            for k, p in zip(at, names):
                ids[k] = new[p]
        if len(cache) < self.most_pieces:  # once full, the cache stays as it is: the frequent pieces came first
            for p in long:
                del new[p]
            cache.update(new)
        out = list(map(b"".join, found))
        for i, ids in zip(unsafe, self._whole(list(unsafe.values())) if unsafe else ()):
            out[i] = ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, most_pieces: int = 900_000) -> Encoder:
    """The worker's encoder for a vocabulary file; one thread, as tasks already fill the cores."""
    import os

    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = Encoder(path, most_pieces)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def texts_in_parts(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about ``most`` characters a part; nulls are empty texts."""
    texts = column.to_pylist()
    at = size = 0
    for i, t in enumerate(texts):
        texts[i] = t = t or ""
        size += len(t)
        if size >= most:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def id_lists(ids: Sequence[bytes]) -> pa.Array:
    """An Arrow list<int32> array of packed ids."""
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def crc32_ids(ids: Column) -> Column:
    """Unsigned CRC-32 of a list of ids as little-endian unsigned 32-bit integers."""

    def run(lists: pa.Array) -> pa.Array:
        values = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").view("u1"))
        bounds = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist()
        known = lists.is_valid().to_pylist()
        return pa.array([zlib.crc32(values[i:j]) if ok else None for i, j, ok in zip(bounds, bounds[1:], known)], pa.int64())

    return F.arrow_udf(run, "long")(ids)


def small_batches(df: DataFrame, rows: int = 512) -> None:
    """Let Arrow batches have few rows, as texts and id lists may be very long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
