"""Column files: Arrow columns to little-endian bytes and back, vectorised with numpy.

Null marks: the least integer of a width, NaN, all ones for dates, timestamps and blob
lengths, and the two bytes 80 00 for texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from colsink.plans.types import BINARIES, STRINGS, TIMESTAMPS, ConversionError, TargetColumn

_DATE = np.dtype([("day", "u1"), ("month", "u1"), ("year", "<i2")])
_STAMP = np.dtype([("micro", "<u4"), ("second", "u1"), ("minute", "u1"), ("hour", "u1"), ("pad", "u1"), ("day", "u1"), ("month", "u1"), ("year", "<i2")])
_NULL_TEXT = b"\x80\x00"


def _nulls(column: pa.Array) -> np.ndarray:
    return np.asarray(column.is_null())


def _integers(column: pa.Array, bits: int) -> bytes:
    values = np.asarray(column.cast(pa.int64()).fill_null(0)).astype(f"<i{bits // 8}")
    values[_nulls(column)] = np.iinfo(values.dtype).min
    return values.tobytes()


def _decimals(column: pa.Array, target: TargetColumn) -> bytes:
    wide = column.cast(pa.decimal128(38, target.scale)).fill_null(0)
    words = np.frombuffer(wide.buffers()[1], "<i8")[2 * wide.offset : 2 * (wide.offset + len(wide))].reshape(-1, 2).copy()
    nulls = _nulls(column)
    if target.bits == 128:
        words[nulls] = (0, np.iinfo(np.int64).min)
        return words.tobytes()
    values = words[:, 0].astype(f"<i{target.bits // 8}")
    values[nulls] = np.iinfo(values.dtype).min
    return values.tobytes()


def _dates(days: np.ndarray) -> dict[str, np.ndarray]:
    d = days.astype("M8[D]")
    months = d.astype("M8[M]")
    return {
        "day": (d - months).astype("i8") + 1,
        "month": months.astype("i8") % 12 + 1,
        "year": months.astype("M8[Y]").astype("i8") + 1970,
    }


def _filled(kind: np.dtype, fields: dict[str, np.ndarray], nulls: np.ndarray) -> bytes:
    out = np.zeros(len(nulls), kind)
    for name, values in fields.items():
        out[name] = values
    raw = out.view("u1").reshape(len(nulls), kind.itemsize)
    raw[nulls] = 0xFF
    return raw.tobytes()


def _stamps(column: pa.Array) -> bytes:
    us = np.asarray(column.cast(pa.timestamp("us", tz=column.type.tz)).cast(pa.int64()).fill_null(0))
    days, rest = np.divmod(us, 86_400_000_000)
    seconds, micro = np.divmod(rest, 1_000_000)
    fields = _dates(days) | {"micro": micro, "second": seconds % 60, "minute": seconds // 60 % 60, "hour": seconds // 3600}
    return _filled(_STAMP, fields, _nulls(column))


def _framed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column without nulls."""
    big = column.cast(pa.large_binary())
    offsets = np.frombuffer(big.buffers()[1], "<i8")[big.offset : big.offset + len(big) + 1]
    data = np.frombuffer(big.buffers()[2] or b"", "u1")[offsets[0] : offsets[-1]] if len(big) else np.empty(0, "u1")
    return data, offsets - offsets[0]


def _texts(column: pa.Array) -> bytes:
    marked = pc.if_else(column.is_null(), pa.scalar(b"\x80", pa.large_binary()), column.cast(pa.large_binary()))
    data, offsets = _framed(marked)
    if len(data) and not data.all():
        raise ConversionError("a text with a zero byte can't be framed")
    out = np.zeros(len(data) + len(column), "u1")
    out[np.arange(len(data)) + np.repeat(np.arange(len(column)), np.diff(offsets))] = data
    return out.tobytes()


def _blobs(column: pa.Array) -> bytes:
    data, offsets = _framed(column.fill_null(b""))
    sizes = np.diff(offsets)
    out = np.empty(len(data) + 8 * len(column), "u1")
    heads = (offsets[:-1] + 8 * np.arange(len(column)))[:, None] + np.arange(8)
    lengths = sizes.astype("<i8")
    lengths[_nulls(column)] = -1
    out[heads.ravel()] = lengths.view("u1")
    out[np.arange(len(data)) + np.repeat(8 * np.arange(1, len(column) + 1), sizes)] = data
    return out.tobytes()


def encode(column: pa.Array | pa.ChunkedArray, target: TargetColumn) -> bytes:
    """The wire bytes of a column that already has the target's type."""
    if isinstance(column, pa.ChunkedArray):
        return b"".join(encode(c, target) for c in column.chunks)
    kind = target.kind
    if not len(column):
        return b""
    if kind == "DECIMAL":
        return _decimals(column, target)
    if target.bits:
        return _integers(column, target.bits)
    if kind in ("REAL", "DOUBLE"):
        width = "f4" if kind == "REAL" else "f8"
        return np.asarray(column.cast(pa.float32() if kind == "REAL" else pa.float64()).fill_null(float("nan"))).astype(f"<{width}").tobytes()
    if kind == "DATE":
        days = np.asarray(column.cast(pa.date32()).cast(pa.int32()).fill_null(0)).astype("i8")
        return _filled(_DATE, _dates(days), _nulls(column))
    if kind in TIMESTAMPS:
        return _stamps(column)
    if kind in STRINGS:
        return _texts(column)
    if kind in BINARIES:
        return _blobs(column)
    raise ConversionError(f"column {target.name}: {target.sql} has no wire form")


def arrow_type(target: TargetColumn) -> pa.DataType:
    """Arrow type of a decoded column."""
    plain = {"BOOLEAN": pa.bool_(), "TINYINT": pa.int8(), "SMALLINT": pa.int16(), "INTEGER": pa.int32(), "BIGINT": pa.int64()}
    plain |= {"REAL": pa.float32(), "DOUBLE": pa.float64(), "DATE": pa.date32(), "TIMESTAMP": pa.timestamp("us")}
    plain |= {"TIMESTAMP WITH TIME ZONE": pa.timestamp("us", tz="UTC")}
    if target.kind == "DECIMAL":
        return pa.decimal128(target.precision, target.scale)
    return pa.string() if target.kind in STRINGS else pa.binary() if target.kind in BINARIES else plain[target.kind]


def _from_fields(raw: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nulls = (raw.view("u1").reshape(-1, kind.itemsize) == 0xFF).all(axis=1)
    months = (raw["year"].astype("i8") - 1970) * 12 + raw["month"] - 1
    days = np.where(nulls, 0, months).astype("M8[M]").astype("M8[D]").astype("i8") + np.where(nulls, 0, raw["day"].astype("i8") - 1)
    return days, nulls, raw


def decode(data: bytes, target: TargetColumn) -> pa.Array:
    """The column that ``encode`` made these bytes of."""
    kind, to = target.kind, arrow_type(target)
    if kind == "DECIMAL":
        if target.bits == 128:
            words = np.frombuffer(data, "<i8").reshape(-1, 2).copy()
        else:
            low = np.frombuffer(data, f"<i{target.bits // 8}")
            least = np.iinfo(low.dtype).min
            words = np.stack([low.astype("i8"), np.where(low < 0, -1, 0)], axis=1).astype("<i8")
            words[low == least] = (0, np.iinfo(np.int64).min)
        nulls = (words[:, 0] == 0) & (words[:, 1] == np.iinfo(np.int64).min)
        words[nulls] = 0
        made = pa.Array.from_buffers(pa.decimal128(38, target.scale), len(words), [None, pa.py_buffer(words.tobytes())])
        return pc.if_else(pa.array(~nulls), made, pa.scalar(None, made.type)).cast(to)
    if target.bits:
        values = np.frombuffer(data, f"<i{target.bits // 8}")
        made = pa.array(values, mask=values == np.iinfo(values.dtype).min)
        return pc.not_equal(made, 0) if kind == "BOOLEAN" else made.cast(to)
    if kind in ("REAL", "DOUBLE"):
        values = np.frombuffer(data, "<f4" if kind == "REAL" else "<f8")
        return pa.array(values, to, mask=np.isnan(values))
    if kind == "DATE":
        days, nulls, _ = _from_fields(np.frombuffer(data, _DATE), _DATE)
        return pa.array(days.astype("i4"), pa.int32(), mask=nulls).cast(to)
    if kind in TIMESTAMPS:
        days, nulls, raw = _from_fields(np.frombuffer(data, _STAMP), _STAMP)
        seconds = days * 86_400 + raw["hour"].astype("i8") * 3600 + raw["minute"].astype("i8") * 60 + raw["second"]
        return pa.array(seconds * 1_000_000 + raw["micro"], pa.int64(), mask=nulls).cast(to)
    if kind in STRINGS:
        items = data.split(b"\x00")[:-1]
        return pa.array([None if x == b"\x80" else x for x in items], pa.binary()).cast(to)
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little", signed=True)
        at += 8
        out.append(None if size < 0 else data[at : at + size])
        at += max(size, 0)
    return pa.array(out, to)
