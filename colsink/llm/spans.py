"""Spans found in texts: the array column they travel in and what is derived from it.

A span is (kind, start, end, score, base): code points, end exclusive. ``base``
marks the spans that a plain pattern already decides; a method only adds to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_SQL = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
SPAN_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
)
Span = tuple[str, int, int, float, bool]


def spans_udf(find: Callable[[str], Sequence[Span]]) -> Callable[[Column], Column]:
    """A column function from texts to span arrays; a null text has no spans."""

    def run(texts: pa.Array) -> pa.Array:
        offsets, kinds, starts, ends, scores, bases = [0], [], [], [], [], []
        for text in texts:
            if text.is_valid:
                for kind, start, end, score, base in find(text.as_py()):
                    kinds.append(kind)
                    starts.append(start)
                    ends.append(end)
                    scores.append(score)
                    bases.append(base)
            offsets.append(len(kinds))
        values = pa.StructArray.from_arrays(
            [
                pa.array(kinds, pa.string()),
                pa.array(starts, pa.int32()),
                pa.array(ends, pa.int32()),
                pa.array(scores, pa.float64()),
                pa.array(bases, pa.bool_()),
            ],
            fields=list(SPAN_ARROW.value_type),
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    # made when called: executors import this module without a session
    return lambda texts: F.arrow_udf(run, SPAN_SQL)(texts)


def digest(spans: Column, kinds: Sequence[str]) -> dict[str, Column]:
    """Counts of the base kinds, the SHA-256 of the base spans, and all spans as text."""

    def joined(found: Column) -> Column:
        return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda x: x["base"] & (x["kind"] == kind))).cast("long")

    base = F.filter(spans, lambda x: x["base"])
    out = {f"n_{k}": count(k) for k in kinds}
    return out | {"base_sha256": F.sha2(joined(base), 256), "spans": joined(spans)}


def in_order(found: list[Span], kinds: Sequence[str]) -> list[Span]:
    """By start, then kind as listed."""
    place = {k: i for i, k in enumerate(kinds)}
    found.sort(key=lambda s: (s[1], place[s[0]], s[2]))
    return found


def digest_text(spans: Sequence[Span]) -> tuple[str, str]:
    """The same digests for one list of spans, in plain Python."""

    def joined(found: Sequence[Span]) -> str:
        return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in found)

    return hashlib.sha256(joined([s for s in spans if s[4]]).encode()).hexdigest(), joined(spans)


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by ``[KIND]`` of its first."""
    out, at, i = [], 0, 0
    spans = sorted(spans, key=lambda s: s[1])
    while i < len(spans):
        kind, start, end = spans[i][:3]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
        i += 1
    return "".join([*out, text[at:]])


def mask_udf(find: Callable[[str], Sequence[Span]]) -> Callable[[Column], Column]:
    """A column function that masks what ``find`` finds; null texts stay null."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            text = value.as_py()
            found = find(text) if text else ()
            out.append(masked(text, found) if found else text)
        return pa.array(out, pa.string())

    return lambda texts: F.arrow_udf(run, "string")(texts)
