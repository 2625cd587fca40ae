"""Wire bytes, back-references, compression and batches."""

import datetime as dt
import random
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colsink.functions import temporal, wire_hex
from colsink.operators import backref, wire
from colsink.operators.batches import batch_numbers
from colsink.operators.compression import Compression, unframed
from colsink.plans.types import ConversionError, TargetColumn

COLUMNS = [
    ("BOOLEAN", [True, None, False], "018000"),
    ("TINYINT", [1, -127, None], "018180"),
    ("SMALLINT", [300, None], "2c010080"),
    ("INTEGER", [1, None, -5], "0100000000000080fbffffff"),
    ("BIGINT", [2**62, None], "00000000000000400000000000000080"),
    ("REAL", [1.5], "0000c03f"),
    ("DOUBLE", [1e300, None], None),
    ("DECIMAL(2,1)", [Decimal("-9.9"), None], "9d80"),
    ("DECIMAL(9,2)", [Decimal("12.34"), None], "d204000000000080"),
    ("DECIMAL(18,3)", [Decimal("-123456789.125"), None], None),
    ("DECIMAL(38,5)", [Decimal("-12345678901234567890123.12345"), None, Decimal("7.00000")], None),
    ("DATE", [dt.date(1969, 12, 31), None, dt.date(2024, 2, 29)], "1f0cb107ffffffff1d02e807"),
    ("TIMESTAMP", [dt.datetime(1950, 3, 1, 23, 59, 59, 999999), None], "3f420f003b3b170001039e07" + "ff" * 12),
    ("TIMESTAMP WITH TIME ZONE", [dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc), None], None),
    ("VARCHAR(5)", ["one", "", None, "é"], "6f6e650000" + "8000" + "c3a900"),
    ("BLOB", [b"\0\1", None, b""], "0200000000000000" + "0001" + "ff" * 8 + "00" * 8),
]


@pytest.mark.parametrize("sql,values,expected", COLUMNS)
def test_wire_round_trip(sql, values, expected):
    target = TargetColumn.parse("x", sql)
    column = pa.array(values, wire.arrow_type(target))
    data = wire.encode(column, target)
    assert expected is None or data.hex() == expected
    assert wire.decode(data, target).to_pylist() == values
    assert wire.encode(column.slice(1), target) == wire.encode(pa.array(values[1:], column.type), target)
    assert wire.encode(column.slice(0, 0), target) == b"" and wire.decode(b"", target).to_pylist() == []
    assert wire.encode(pa.chunked_array([column, column]), target) == data * 2


def test_a_zero_byte_cannot_be_framed():
    with pytest.raises(ConversionError):
        wire.encode(pa.array(["a\0b"]), TargetColumn.parse("x", "TEXT"))


@pytest.mark.parametrize(
    "items,expected",
    [
        ([b"A", None, None], b"A\x00\x80\x00\x81"),
        ([b"A", b"A", b"", b"", None, None, b"A"], b"A\x00\x81\x00\x81\x80\x00\x81\x85"),
        ([], b""),
    ],
)
def test_back_references_of_short_texts(items, expected):
    assert backref.Encoder().encode(items) == expected
    assert backref.decode(expected) == items


def test_distances():
    assert backref.reference(63) == b"\xbf" and backref.reference(64) == b"\x80\x40" and backref.reference(500) == b"\x80\xf4\x03"
    items = [b"x"] + [bytes([65 + i % 26, 65 + i // 26]) for i in range(499)] + [b"x"]
    assert backref.Encoder().encode(items).endswith(b"\x80\xf4\x03")


@pytest.mark.parametrize("seed", range(12))
def test_back_references_can_be_decoded(seed):
    r = random.Random(seed)
    words = [None, b"", b"x", "é".encode()] + [bytes(r.choices(b"abcdef", k=r.randint(1, 400))) for _ in range(r.choice((3, 200, 4000)))]
    items = [r.choice(words) for _ in range(6000)]
    encoder = backref.Encoder(r.choice((0, 1, 8192, 65536, 1 << 30)))
    data = encoder.encode(items[:2500]) + encoder.encode(items[2500:])
    assert backref.decode(data) == items


@pytest.mark.parametrize("memory", [0, 8192])
@pytest.mark.parametrize("seed", range(8))
def test_columns_equal_items(seed, memory):
    r = random.Random(seed)
    words = [None, b"", b"x", b"y", "é".encode(), b"long", b"\xff"][: r.randint(1, 7)] + [b"%d" % i for i in range(300)] * r.randint(0, 2)
    items = [r.choice(words) for _ in range(r.choice((0, 1, 50, 4000)))]
    one, two = backref.Encoder(memory), backref.Encoder(memory)
    column = pa.array(items + [None], pa.binary()).slice(0, len(items))
    cut = len(items) // 3
    assert two.encode_array(column.slice(0, cut)) + two.encode_array(column.slice(cut)) == one.encode(items)


def test_memory_is_bounded():
    encoder = backref.Encoder(8192)
    encoder.encode(b"%d" % i for i in range(50_000))
    assert len(encoder.young) + len(encoder.old) < 2 * 8192 // 16


@pytest.mark.parametrize("bad", [b"\x81", b"A\x00\x82", b"abc", b"\x80\x80"])
def test_broken_references(bad):
    with pytest.raises(ValueError):
        backref.decode(bad)


def test_memory_sizes():
    assert [backref.memory_size(x) for x in ("0", "64k", "1M", "-1")] == [0, 65536, 1 << 20, -1]
    for bad in ("", "x", "-2", "-1k", "1g"):
        with pytest.raises(ValueError):
            backref.memory_size(bad)


def test_window_distances_equal_the_encoder(spark):
    items = [None, "a", "", "a", None, "", "b", "a", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string").withColumn("p", F.lit(1))
    found = {r["i"]: r["distance"] for r in backref.distances(df, "v", ["p"], ["i"]).collect()}
    last, expected = {}, {}
    for i, v in enumerate(items):
        expected[i] = i - last[v] if v in last else None
        last[v] = i
    assert found == expected


@pytest.mark.parametrize("option", ["lz4", "LZ4:1", "lz4:9", "lz4:17"])
def test_frames(option):
    c, data = Compression.parse(option), b"hello world " * 1000
    framed = c.frame(data) + c.frame(b"") + c.frame(b"x")
    assert framed[:4].hex() == "04224d18" and unframed(framed) == data + b"x" and c.suffix == ".lz4"


def test_compression_options():
    assert Compression.parse("none").frame(b"x") == b"x" and Compression.parse("none").suffix == ""
    for bad in ("", "lz4:18", "gzip", "lz4:-1", "lz4:"):
        with pytest.raises(ValueError):
            Compression.parse(bad)


def test_hex_equals_the_wire(spark):
    rows = [(1, dt.datetime(2024, 2, 29, 1, 2, 3, 456789), "é"), (-2, dt.datetime(1950, 1, 1), ""), (None, None, None)]
    df = spark.createDataFrame(rows, "i int, t timestamp_ntz, s string")
    made = df.select(
        wire_hex.little_endian(F.col("i"), 4), wire_hex.timestamp(F.col("t")), wire_hex.date(F.col("t").cast("date")), wire_hex.text(F.col("s")), wire_hex.blob(F.encode("s", "UTF-8"))
    ).collect()
    at = [
        (pa.array([r[0] for r in rows], pa.int32()), "INTEGER"),
        (pa.array([r[1] for r in rows], pa.timestamp("us")), "TIMESTAMP"),
        (pa.array([r[1] and r[1].date() for r in rows], pa.date32()), "DATE"),
        (pa.array([r[2] for r in rows]), "TEXT"),
        (pa.array([None if r[2] is None else r[2].encode() for r in rows], pa.binary()), "BLOB"),
    ]
    for i, (column, sql) in enumerate(at):
        target = TargetColumn.parse("x", sql)
        assert [r[i] for r in made] == [wire.encode(column.slice(k, 1), target).hex().upper() for k in range(3)]


def test_reference_hex(spark):
    df = spark.createDataFrame([(d,) for d in (1, 63, 64, 127, 128, 500, 20000, 3_000_000)], "d long")
    assert [r[0] for r in df.select(wire_hex.back_reference(F.col("d"))).collect()] == [backref.reference(d).hex().upper() for d in (1, 63, 64, 127, 128, 500, 20000, 3_000_000)]


def test_batches(spark):
    df = batch_numbers(spark.range(2500).withColumn("g", F.col("id") % 2), 500, ["g"], [F.col("id")])
    assert sorted(tuple(r) for r in df.groupBy("g", "batch").count().collect()) == [(g, b, 500 if b < 2 else 250) for g in (0, 1) for b in (0, 1, 2)]
    with pytest.raises(ValueError):
        batch_numbers(df, 0, ["g"], [F.col("id")])


def test_intervals(spark):
    df = spark.createDataFrame([("-0.500", -13), ("90061.001", 25)], "s string, m int")
    made = df.select(temporal.day_time_micros(F.col("s")), temporal.day_time(F.col("s")).cast("string"), temporal.year_month(F.col("m")).cast("string")).collect()
    assert made[0][0] == -500_000 and "-0 00:00:00.5" in made[0][1] and "-1-1" in made[0][2]
    assert made[1][0] == 90_061_001_000 and "2-1" in made[1][2]
