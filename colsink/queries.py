"""Queries that exercise the operators on the shared tables, and the same in SQL."""

from __future__ import annotations

import contextlib
import io
import tempfile
import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colsink import cli
from colsink.functions import temporal, wire_hex
from colsink.metrics import counted
from colsink.operators.backref import distances, is_short
from colsink.operators.batches import batch_numbers
from colsink.plans.conversion import bind, convert, overflow_counts, plan
from colsink.plans.types import TargetColumn, sql_type
from colsink.sources import embedded, jdbc, scans, tables
from colsink.sources.column_files import dump_metrics, read_dump, write_dump
from colsink.streaming import stream_dump

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL form."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checked(df: DataFrame, column: str, sql: str, into: str = "x") -> Column:
    """A column as a target of that SQL type, null where it is out of range."""
    return convert(F.col(column), df.schema[column].dataType, TargetColumn.parse(into, sql), True).alias(into)


# conversions


@query("SELECT p_partkey, CASE WHEN p_size * 5 BETWEEN -127 AND 127 THEN (p_size * 5)::TINYINT END AS x FROM part")
def conv_int_to_tinyint_null(spark, d):
    df = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 5).alias("v"))
    return df.select("p_partkey", checked(df, "v", "TINYINT"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey BETWEEN -32767 AND 32767 THEN l_orderkey::SMALLINT END AS x FROM lineitem")
def conv_int_to_smallint_null(spark, d):
    df = table(spark, d, "lineitem")
    return df.select("l_orderkey", "l_linenumber", checked(df, "l_orderkey", "SMALLINT"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey * 1000003 BETWEEN -2147483647 AND 2147483647 THEN (o_orderkey * 1000003)::INTEGER END AS x FROM orders")
def conv_bigint_to_int_null(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 1000003).alias("v"))
    return df.select("o_orderkey", checked(df, "v", "INTEGER"))


@query("SELECT vec_id, CASE WHEN label BETWEEN 0 AND 1 THEN label = 1 END AS x FROM embeddings")
def conv_int_to_boolean_null(spark, d):
    df = table(spark, d, "embeddings")
    return df.select("vec_id", checked(df, "label", "BOOLEAN"))


@query("SELECT l_orderkey, l_linenumber, (l_quantity > 25)::TINYINT AS x FROM lineitem")
def conv_bool_to_int(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") > 25).alias("v"))
    return df.select("l_orderkey", "l_linenumber", checked(df, "v", "TINYINT"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN -9999 AND 9999 THEN o_orderkey::DECIMAL(4,0) END AS x FROM orders")
def conv_int_to_decimal(spark, d):
    df = table(spark, d, "orders")
    return df.select("o_orderkey", checked(df, "o_orderkey", "DECIMAL(4,0)"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey * 3 BETWEEN -32767 AND 32767 THEN (l_orderkey * 3)::SMALLINT END AS x FROM lineitem")
def conv_decimal_narrow_null(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 3).cast("decimal(33,0)").alias("v"))
    return df.select("l_orderkey", "l_linenumber", checked(df, "v", "SMALLINT"))


@query("SELECT o_orderkey, o_totalprice::DECIMAL(12,2)::DECIMAL(38,2) AS x FROM orders")
def conv_decimal_widen(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    return df.select("o_orderkey", checked(df, "v", "DECIMAL(38,2)"))


@query("SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN value END AS x FROM events")
def conv_double_finite_null(spark, d):
    bad = F.when(F.col("user_id") % 14 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    df = table(spark, d, "events").select("event_id", F.when(F.col("user_id") % 7 == 0, bad).otherwise(F.col("value")).alias("v"))
    return df.select("event_id", checked(df, "v", "DOUBLE"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value::FLOAT END AS x FROM events")
def conv_double_to_real(spark, d):
    v = F.when(F.col("event_id") % 5 == 0, F.lit(1e300)).otherwise(F.col("value"))
    df = table(spark, d, "events").select("event_id", v.alias("v"))
    return df.select("event_id", checked(df, "v", "REAL"))


@query("SELECT c_custkey, c_name AS x FROM customer")
def conv_string_to_varchar(spark, d):
    df = table(spark, d, "customer")
    return df.select("c_custkey", checked(df, "c_name", "VARCHAR(25)"))


@query("SELECT o_orderkey, o_orderdate::DATE AS x, o_orderdate AS y FROM orders")
def conv_temporal(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("a"), F.col("o_orderdate").alias("b"))
    return df.select("o_orderkey", checked(df, "a", "DATE"), checked(df, "b", "TIMESTAMP", "y"))


@query("SELECT c_acctbal AS c_acctbal, c_name AS c_name, NULL::INTEGER AS c_extra, c_custkey AS c_custkey FROM customer")
def bind_by_name_reorder(spark, d):
    df = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    targets = [TargetColumn.parse(n, t) for n, t in (("c_acctbal", "DOUBLE"), ("c_name", "TEXT"), ("c_extra", "INTEGER"), ("c_custkey", "BIGINT"))]
    given = {f.name for f, _ in bind(df.schema, targets)}
    made = plan(df, targets, True)
    return made.select(*[F.col(t.name) if t.name in given else F.lit(None).cast("int").alias(t.name) for t in targets])


_TOO_WIDE = {"l_orderkey": "SMALLINT", "l_partkey": "TINYINT", "l_linenumber": "BOOLEAN", "l_quantity": "REAL"}


@query(
    """SELECT sum((l_orderkey NOT BETWEEN -32767 AND 32767)::BIGINT)::BIGINT AS l_orderkey, sum((l_partkey NOT BETWEEN -127 AND 127)::BIGINT)::BIGINT AS l_partkey,
    sum((l_linenumber NOT BETWEEN 0 AND 1)::BIGINT)::BIGINT AS l_linenumber, 0::BIGINT AS l_quantity FROM lineitem"""
)
def overflow_report(spark, d):
    df = table(spark, d, "lineitem").select(*_TOO_WIDE)
    return overflow_counts(df, [TargetColumn.parse(n, t) for n, t in _TOO_WIDE.items()])


@query("SELECT p_partkey, CASE WHEN p_partkey % 256 <> 0 THEN (p_partkey % 256 - 128)::TINYINT END AS x, (p_partkey % 256 - 128)::INTEGER AS y FROM part")
def conv_byte_source(spark, d):
    df = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 256 - 128).cast("tinyint").alias("v"))
    return df.select("p_partkey", checked(df, "v", "TINYINT"), checked(df, "v", "INTEGER", "y"))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 1000 - 500 BETWEEN -127 AND 127 THEN (l_orderkey % 1000 - 500)::TINYINT END AS x,
    (l_orderkey % 1000 - 500)::BIGINT AS y FROM lineitem"""
)
def conv_short_source(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 1000 - 500).cast("smallint").alias("v"))
    return df.select("l_orderkey", "l_linenumber", checked(df, "v", "TINYINT"), checked(df, "v", "BIGINT", "y"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value::FLOAT END AS x, CASE WHEN event_id % 5 <> 0 THEN value::FLOAT::DOUBLE END AS y FROM events")
def conv_float_source(spark, d):
    v = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).cast("float")
    df = table(spark, d, "events").select("event_id", v.alias("v"))
    return df.select("event_id", checked(df, "v", "REAL"), checked(df, "v", "DOUBLE", "y"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN hex(encode(c_name)) END AS hex FROM customer")
def conv_binary(spark, d):
    v = F.when(F.col("c_custkey") % 7 != 0, F.encode("c_name", "UTF-8"))
    df = table(spark, d, "customer").select("c_custkey", v.alias("v"))
    return df.select("c_custkey", F.hex(checked(df, "v", "BLOB")).alias("hex"))


@query(
    """SELECT 'l_orderkey' AS name, coalesce(bool_or(l_orderkey NOT BETWEEN -32767 AND 32767), FALSE) AS fails FROM lineitem
    UNION ALL SELECT 'l_partkey', coalesce(bool_or(l_partkey NOT BETWEEN -127 AND 127), FALSE) FROM lineitem
    UNION ALL SELECT 'l_linenumber', coalesce(bool_or(l_linenumber NOT BETWEEN 0 AND 1), FALSE) FROM lineitem
    UNION ALL SELECT 'l_quantity', FALSE"""
)
def conversion_errors(spark, d):
    """Which columns a strict write stops at."""
    df, rows = table(spark, d, "lineitem"), []
    for name, kind in _TOO_WIDE.items():
        made = convert(F.col(name), df.schema[name].dataType, TargetColumn.parse(name, kind), False)
        try:
            df.agg(F.count(made)).collect()
            rows.append((name, False))
        except PySparkException as e:
            if "Value out of range" not in str(e):
                raise
            rows.append((name, True))
    return spark.createDataFrame(rows, "name string, fails boolean")


# wire values


def _le(sql: str, size: int) -> str:
    low = f"right(lpad(to_hex(({sql})::BIGINT), 16, '0'), {2 * size})"
    pairs = f"list_aggregate(list_reverse(regexp_extract_all({low}, '..')), 'string_agg', '')"
    return f"CASE WHEN ({sql}) IS NULL THEN '{'00' * (size - 1)}80' ELSE {pairs} END"


def _int_hex(bits: int, expr: str) -> None:
    def f(spark, d):
        df = table(spark, d, "orders").select("o_orderkey", F.expr(expr).alias("v"))
        stored = df.select("o_orderkey", checked(df, "v", {8: "TINYINT", 16: "SMALLINT", 32: "INTEGER", 64: "BIGINT"}[bits]))
        return stored.select("o_orderkey", wire_hex.little_endian(F.col("x"), bits // 8).alias("hex"))

    top = (1 << (bits - 1)) - 1
    inside = f"CASE WHEN {expr} BETWEEN -{top} AND {top} THEN {expr} END"
    QUERIES[f"wire_int{bits}_hex"] = f
    ORACLE_SQL[f"wire_int{bits}_hex"] = f"SELECT o_orderkey, {_le(inside, bits // 8)} AS hex FROM orders"


_int_hex(8, "(o_orderkey % 300 - 150)")
_int_hex(16, "(o_orderkey * 7 - 40000)")
_int_hex(32, "(o_orderkey * 1000003 - 5000000000)")
_int_hex(64, "(o_orderkey * 100000000003 - 700000000000000)")

_DATE_SQL = "{day} || {month} || {year}".format(day=_le("day({0})", 1), month=_le("month({0})", 1), year=_le("year({0})", 2))


@query(f"SELECT o_orderkey, {_DATE_SQL.format('o_orderdate')} AS hex FROM orders")
def wire_date_hex(spark, d):
    return table(spark, d, "orders").select("o_orderkey", wire_hex.date(F.col("o_orderdate").cast("date")).alias("hex"))


@query(
    f"""SELECT event_id, {_le("epoch_us(ts) % 1000000", 4)} || {_le("date_part('second', ts)", 1)} || {_le("minute(ts)", 1)} || {_le("hour(ts)", 1)} || '00' || {_DATE_SQL.format("ts")} AS hex FROM events"""
)
def wire_timestamp_hex(spark, d):
    return table(spark, d, "events").select("event_id", wire_hex.timestamp(F.col("ts")).alias("hex"))


@query("SELECT c_custkey, hex(encode(c_name)) || '00' AS hex FROM customer UNION ALL SELECT -c_custkey, '8000' FROM customer WHERE c_custkey % 10 = 0")
def wire_string_hex(spark, d):
    df = table(spark, d, "customer")
    nulls = df.where("c_custkey % 10 = 0").select((-F.col("c_custkey")).alias("c_custkey"), F.lit(None).cast("string").alias("c_name"))
    return df.select("c_custkey", "c_name").union(nulls).select("c_custkey", wire_hex.text(F.col("c_name")).alias("hex"))


@query(f"SELECT c_custkey, {_le('octet_length(encode(c_name))', 8)} || hex(encode(c_name)) AS hex FROM customer")
def wire_blob_hex(spark, d):
    return table(spark, d, "customer").select("c_custkey", wire_hex.blob(F.encode("c_name", "UTF-8")).alias("hex"))


# back-references


@query(
    """WITH n AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag) AS i FROM lineitem)
    SELECT l_orderkey, l_linenumber, i - lag(i) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY i) AS distance FROM n"""
)
def backref_delta_short(spark, d):
    df = table(spark, d, "lineitem").where(is_short(F.col("l_returnflag")))
    out = distances(df, "l_returnflag", ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag"])
    return out.select("l_orderkey", "l_linenumber", F.col("distance").cast("bigint").alias("distance"))


_EVENT_DISTANCE = """n AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id % 16 ORDER BY event_id) AS i FROM events),
    r AS (SELECT event_id, event_type, i - lag(i) OVER (PARTITION BY user_id % 16, event_type ORDER BY i) AS distance FROM n)"""


def _event_distances(spark, d) -> DataFrame:
    df = table(spark, d, "events").withColumn("b", F.col("user_id") % 16)
    return distances(df, "event_type", ["b"], ["event_id"]).select("event_id", "event_type", F.col("distance").cast("bigint").alias("distance"))


@query(f"WITH {_EVENT_DISTANCE} SELECT event_id, distance FROM r")
def backref_delta_unbounded(spark, d):
    return _event_distances(spark, d).select("event_id", "distance")


@query(
    f"""WITH {_EVENT_DISTANCE} SELECT event_id, CASE WHEN distance IS NULL THEN hex(encode(event_type)) || '00' WHEN distance < 64 THEN {_le("128 + distance", 1)}
    WHEN distance < 128 THEN '80' || {_le("distance", 1)} ELSE '80' || {_le("distance % 128 + 128", 1)} || {_le("distance // 128", 1)} END AS hex FROM r"""
)
def backref_bytes_hex(spark, d):
    df = _event_distances(spark, d)
    return df.select("event_id", F.coalesce(wire_hex.back_reference(F.col("distance")), wire_hex.text(F.col("event_type"))).alias("hex"))


# batches, scans, limits


@query("WITH n AS (SELECT l_suppkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1) // 100 AS batch FROM lineitem) SELECT l_suppkey, batch, count(*) AS n FROM n GROUP BY ALL")
def batch_assign(spark, d):
    df = batch_numbers(table(spark, d, "lineitem"), 100, ["l_suppkey"], [F.col("l_orderkey"), F.col("l_linenumber")])
    return df.groupBy("l_suppkey", "batch").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def scan_filter(spark, d):
    return table(spark, d, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000)).select("o_orderkey", "o_totalprice")


@query("SELECT event_id FROM events WHERE props IS NOT NULL AND value IS NOT NULL")
def scan_filter_null(spark, d):
    return table(spark, d, "events").where("props IS NOT NULL AND value IS NOT NULL").select("event_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5")
def topk_offset(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(5).limit(10)


def _stride_sql(value: str, lo: int, hi: int, parts: int) -> str:
    return f"greatest(0, least({parts - 1}, floor(({value} - {lo}) / {max(1, (hi - lo) // parts)}.0)))::INTEGER"


@query(f"SELECT {_stride_sql('l_partkey', 100, 1700, 4)} AS part, count(*) AS n, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem GROUP BY ALL")
def scan_partition_int(spark, d):
    df = table(spark, d, "lineitem").withColumn("part", scans.stride(F.col("l_partkey"), 100, 1700, 4))
    return df.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"))


@query(f"SELECT {_stride_sql('(o_orderdate::DATE - DATE ' + chr(39) + '1970-01-01' + chr(39) + ')', 8400, 10400, 8)} AS part, count(*) AS n FROM orders GROUP BY ALL")
def scan_partition_date(spark, d):
    days = F.unix_date(F.col("o_orderdate").cast("date"))
    return table(spark, d, "orders").groupBy(scans.stride(days, 8400, 10400, 8).alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {_stride_sql('epoch_us(ts)', 1_700_000_000_000_000, 1_710_000_000_000_000, 8)} AS part, count(*) AS n FROM events GROUP BY ALL")
def scan_partition_timestamp(spark, d):
    us = temporal.micros(F.col("ts"))
    return table(spark, d, "events").groupBy(scans.stride(us, 1_700_000_000_000_000, 1_710_000_000_000_000, 8).alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n, count(DISTINCT l_partkey) AS parts, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem")
def verify_counts(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_partkey").alias("parts"), F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"))


@query("SELECT * FROM customer WHERE FALSE")
def empty_schema_probe(spark, d):
    return scans.probe(table(spark, d, "customer"))


# temporal and interval values, definitions


@query("SELECT event_id, year(ts)::INTEGER AS y, month(ts)::INTEGER AS m, day(ts)::INTEGER AS dd, hour(ts)::INTEGER AS h, minute(ts)::INTEGER AS mi, date_part('second', ts)::INTEGER AS s, (epoch_us(ts) % 1000000)::INTEGER AS us FROM events")
def ts_ntz_fields(spark, d):
    names = {"year": "y", "month": "m", "day": "dd", "hour": "h", "minute": "mi", "second": "s", "micro": "us"}
    df = table(spark, d, "events").withColumn("ts", temporal.wall_clock(F.col("ts")))
    return df.select("event_id", *[c.alias(names[k]) for k, c in temporal.timestamp_fields(F.col("ts")).items()])


@query("SELECT event_id, epoch_us(ts) AS us FROM events")
def ts_micros(spark, d):
    return table(spark, d, "events").select("event_id", temporal.micros(F.col("ts")).alias("us"))


@query("SELECT p_partkey, (p_size - 20) // 1 AS months FROM part")
def interval_months(spark, d):
    made = temporal.year_month(F.col("p_size") - 20)
    months = F.extract(F.lit("YEAR"), made) * 12 + F.extract(F.lit("MONTH"), made)
    return table(spark, d, "part").select("p_partkey", months.cast("int").alias("months"))


@query("SELECT event_id, (event_id * 137 - 500000) * 1000 AS us FROM events")
def interval_micros(spark, d):
    seconds = (F.col("event_id") * 137 - 500000).cast("decimal(18,3)") / F.lit(Decimal(1000))
    made = temporal.day_time(seconds)
    rest = F.extract(F.lit("SECOND"), made).cast("decimal(18,6)") + F.extract(F.lit("MINUTE"), made) * 60 + F.extract(F.lit("HOUR"), made) * 3600
    us = (rest + F.extract(F.lit("DAY"), made) * 86400) * 1000000
    return table(spark, d, "events").select("event_id", us.cast("bigint").alias("us"))


@query(
    """SELECT * FROM (VALUES ('c_acctbal', 'DOUBLE'), ('c_custkey', 'BIGINT'), ('c_mktsegment', 'CLOB'), ('c_name', 'CLOB'), ('c_nationkey', 'BIGINT')) t(name, type)"""
)
def ddl_type_map(spark, d):
    rows = [(f.name, sql_type(f.dataType)) for f in table(spark, d, "customer").schema]
    return spark.createDataFrame(rows, "name string, type string")


# dumps


def _shared(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{named.rstrip('/')}/dump-{uuid.uuid4().hex}" if named else tempfile.mkdtemp(prefix="dump-")


def _round_trip(name: str, of: str, **options: str) -> None:
    def f(spark, d):
        path = _shared(spark)
        df = table(spark, d, of)
        write_dump(df, path, **options)
        stored = read_dump(spark, path)
        return stored.select(*[F.col(x.name).cast(x.dataType) for x in df.schema])

    QUERIES[name], ORACLE_SQL[name] = f, f"SELECT * FROM {of}"


for _name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
    _round_trip(f"dump_roundtrip_{_name}", _name)
_round_trip("dump_roundtrip_lz4", "lineitem", compression="lz4", batchsize="10000")
_round_trip("dump_roundtrip_backref", "orders", backrefsize="64k")
_round_trip("dump_roundtrip_documents", "documents", backrefsize="1M", compression="lz4:9")


@query("SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_regionkey = 1")
def append_union_all(spark, d):
    path, df = _shared(spark), table(spark, d, "nation")
    write_dump(df, path)
    write_dump(df.where("n_regionkey = 1"), path)
    return read_dump(spark, path).select(*[F.col(x.name).cast(x.dataType) for x in df.schema])


@query("SELECT * FROM nation WHERE n_regionkey = 2")
def overwrite_replace(spark, d):
    path, df = _shared(spark), table(spark, d, "nation")
    write_dump(df, path)
    write_dump(df.where("n_regionkey = 2"), path, mode="overwrite")
    return read_dump(spark, path).select(*[F.col(x.name).cast(x.dataType) for x in df.schema])


_ROWS_OF_TWO = "SELECT * FROM nation WHERE n_regionkey = 2"


@query(_ROWS_OF_TWO)
def truncate_replace(spark, d):
    path, df = _shared(spark), table(spark, d, "nation")
    write_dump(df, path)
    write_dump(df.where("n_regionkey = 2"), path, mode="overwrite", truncate="true")
    return read_dump(spark, path).select(*[F.col(x.name).cast(x.dataType) for x in df.schema])


_round_trip("dump_immediate_commit", "customer", batchsize="100", immediatecommit="true")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN ((o_orderkey - 1000)::HUGEINT * 100000000000000000000)::DECIMAL(38,0) END AS big FROM orders")
def dump_roundtrip_int128(spark, d):
    path = _shared(spark)
    big = ((F.col("o_orderkey") - 1000).cast("decimal(18,0)") * F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)")
    df = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, big).alias("big"))
    write_dump(df, path, [TargetColumn.parse("o_orderkey", "BIGINT"), TargetColumn.parse("big", "DECIMAL(38,0)")])
    return read_dump(spark, path)


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value::FLOAT END AS x FROM events")
def dump_roundtrip_real(spark, d):
    path = _shared(spark)
    write_dump(table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value").cast("float")).alias("x")), path)
    return read_dump(spark, path).select("event_id", F.col("x").cast("float").alias("x"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN epoch_us(ts) END AS us FROM events")
def dump_roundtrip_instant(spark, d):
    """Instants keep their microseconds, whatever the zone of their wall clock."""
    path = _shared(spark)
    at = F.when(F.col("event_id") % 5 != 0, temporal.instant(F.col("ts")))
    write_dump(table(spark, d, "events").select("event_id", at.alias("at")), path, [TargetColumn.parse("event_id", "BIGINT"), TargetColumn.parse("at", "TIMESTAMP WITH TIME ZONE")])
    return read_dump(spark, path).select("event_id", temporal.micros(F.col("at")).alias("us"))


_NATION_FILES = ", ".join(f"R''/load/part0/batch' || b || '/col{i}.{n}.bin''" for i, n in enumerate(("n_nationkey", "n_name", "n_regionkey")))


@query(
    f"""WITH b AS (SELECT i // 10 AS b, count(*) AS n FROM (SELECT row_number() OVER () - 1 AS i FROM nation) GROUP BY ALL)
    SELECT '/* colsink: ' || n || ' rows */' || chr(10) || 'COPY LITTLE ENDIAN BINARY INTO dump("n_nationkey", "n_name", "n_regionkey")' || chr(10)
    || 'FROM {_NATION_FILES}' || chr(10) || 'ON SERVER;' || chr(10) AS statement FROM b"""
)
def copy_statements(spark, d):
    path = _shared(spark)
    write_dump(table(spark, d, "nation").coalesce(1), path, dumpdir=path, dumpprefix="/load", dumponserver="true", batchsize="10")
    return spark.read.text(f"{path}/part*/batch*/copy.sql", wholetext=True).withColumnRenamed("value", "statement")


@query(
    """SELECT unnest(['CREATE TABLE c (' || chr(10) || '  "c_custkey" BIGINT,' || chr(10) || '  "c_name" CLOB,' || chr(10) || '  "c_nationkey" BIGINT,' || chr(10)
    || '  "c_acctbal" DOUBLE,' || chr(10) || '  "c_mktsegment" CLOB' || chr(10) || ');' || chr(10), 'DROP TABLE c;' || chr(10), 'TRUNCATE TABLE c RESTRICT;' || chr(10)]) AS statement"""
)
def define_statements(spark, d):
    path = _shared(spark)
    write_dump(table(spark, d, "customer"), path, dbtable="c")
    return spark.read.text([f"{path}/{n}.sql" for n in ("create", "drop", "truncate")], wholetext=True).withColumnRenamed("value", "statement")


@query("SELECT count(*) AS dumped, count(*) AS observed FROM orders")
def metric_rows(spark, d):
    """Rows as the writers' metrics and an observation of the input have them."""
    path = _shared(spark)
    df, seen = counted(table(spark, d, "orders"))
    write_dump(df, path)
    return spark.createDataFrame([(dump_metrics(path)["row_count"], seen.get["row_count"])], "dumped long, observed long")


@query("SELECT * FROM nation")
def stream_append(spark, d):
    base = _shared(spark)
    table(spark, d, "nation").repartition(3).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(table(spark, d, "nation").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    stream_dump(stream, f"{base}/out", f"{base}/state", once=True).awaitTermination()
    return read_dump(spark, f"{base}/out").select(*[F.col(x.name).cast(x.dataType) for x in stream.schema])


# files and ranges


def _file_scan(kind: str) -> None:
    def f(spark, d):
        df, path = table(spark, d, "customer"), _shared(spark)
        df.write.format(kind).save(path)
        return scans.read_file(spark, path, kind, df.schema)

    QUERIES[f"scan_file_{kind}"], ORACLE_SQL[f"scan_file_{kind}"] = f, "SELECT * FROM customer"


for _name in scans.FORMATS:
    _file_scan(_name)


@query("SELECT range AS id, range % 10 AS digit FROM range(10, 10000, 7)")
def range_source(spark, d):
    return spark.range(10, 10000, 7).select("id", (F.col("id") % 10).alias("digit"))


@query("SELECT row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS place, c_custkey FROM customer QUALIFY place <= 100")
def sorted_places(spark, d):
    top = table(spark, d, "customer").orderBy(F.desc_nulls_last("c_acctbal"), "c_custkey").limit(100)
    rows = [(i + 1, r[0]) for i, r in enumerate(top.select("c_custkey").collect())]
    return spark.createDataFrame(rows, "place long, c_custkey long")


# JDBC tables


def _store(spark: SparkSession) -> str:
    """URL of a new embedded store: in memory where the session is one process, else a folder that its driver opens."""
    at = "memory:" if embedded.one_process(spark) else f"{embedded.shared_folder(spark, 'tables')}/"
    return f"jdbc:derby:{at}q{uuid.uuid4().hex};create=true"


def _as_before(stored: DataFrame, df: DataFrame) -> DataFrame:
    return stored.select(*[F.col(f"`{x.name}`").cast(x.dataType) for x in df.schema])


def _jdbc_mode(name: str, sql: str, *writes: tuple[str | None, dict]) -> None:
    """A query that writes parts of ``nation`` one after another and reads what is stored."""

    def f(spark, d):
        url, df = _store(spark), table(spark, d, "nation")
        for where, options in writes:
            try:
                jdbc.write(df.where(where) if where else df, url, "nation", **options)
            except ValueError:
                if options.get("mode") != "error":
                    raise
        return _as_before(jdbc.read(spark, url, "nation"), df)

    QUERIES[name], ORACLE_SQL[name] = f, sql


_jdbc_mode("jdbc_append", "SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_regionkey = 1", (None, {}), ("n_regionkey = 1", {}))
_jdbc_mode("jdbc_overwrite", _ROWS_OF_TWO, (None, {}), ("n_regionkey = 2", {"mode": "overwrite"}))
_jdbc_mode("jdbc_truncate", _ROWS_OF_TWO, (None, {}), ("n_regionkey = 2", {"mode": "overwrite", "truncate": True}))
_jdbc_mode("jdbc_ignore", _ROWS_OF_TWO, ("n_regionkey = 2", {"mode": "ignore"}), (None, {"mode": "ignore"}))
_jdbc_mode("jdbc_error", _ROWS_OF_TWO, ("n_regionkey = 2", {"mode": "error"}), (None, {"mode": "error"}))


def _stored_customers(spark: SparkSession, d: str) -> str:
    url = _store(spark)
    jdbc.write(table(spark, d, "customer"), url, "customer")
    return url


@query("SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey::TINYINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def jdbc_typed_scan(spark, d):
    return jdbc.read(spark, _stored_customers(spark, d), "customer", types={"c_custkey": "INTEGER", "c_nationkey": "TINYINT"})


@query(f"SELECT {_stride_sql('c_custkey', 0, 1000, 4)} AS part, count(*) AS n FROM customer GROUP BY ALL")
def jdbc_partitioned_scan(spark, d):
    rows = jdbc.read(spark, _stored_customers(spark, d), "customer", partition=("c_custkey", "0", "1000", 4))
    return rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_custkey > 50 GROUP BY ALL")
def jdbc_query_scan(spark, d):
    inner = '(SELECT "c_nationkey", "c_custkey" FROM customer) q'
    rows = jdbc.read(spark, _stored_customers(spark, d), inner, types={"c_nationkey": "INTEGER"}).where("c_custkey > 50")
    return rows.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10 OFFSET 5")
def jdbc_topk_offset(spark, d):
    rows = jdbc.read(spark, _stored_customers(spark, d), "customer")
    return rows.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").offset(5).limit(10)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 100")
def jdbc_catalog_scan(spark, d):
    name = f"store_{uuid.uuid4().hex}"
    jdbc.catalog(spark, name, _stored_customers(spark, d))
    return spark.sql(f"SELECT c_custkey, c_acctbal FROM {name}.APP.CUSTOMER WHERE c_acctbal > 100")


@query("SELECT * FROM nation")
def jdbc_init_statement(spark, d):
    """The session's schema is set first, so the table of that schema is read."""
    url, df = _store(spark), table(spark, d, "nation")
    jdbc.write(df.limit(0), url, "nation")
    with tables.connection(spark, url) as conn:
        tables.execute(conn, "CREATE SCHEMA other")
    jdbc.write(df, url, "other.nation")
    return _as_before(jdbc.read(spark, url, "nation", init="SET SCHEMA OTHER"), df)


@query("SELECT * FROM (VALUES ('c_custkey', 'BIGINT'), ('c_name', 'CLOB'), ('c_nationkey', 'BIGINT'), ('c_acctbal', 'DOUBLE'), ('c_mktsegment', 'CLOB')) t(name, type)")
def jdbc_probe_columns(spark, d):
    found = jdbc.probe(spark, _stored_customers(spark, d), "customer")
    return spark.createDataFrame([(c.name, c.kind) for c in found], "name string, type string")


@query("SELECT FALSE AS stored")
def jdbc_drop(spark, d):
    url = _stored_customers(spark, d)
    with tables.connection(spark, url) as conn:
        tables.drop(conn, "customer")
    return spark.createDataFrame([(jdbc.probe(spark, url, "customer") is not None,)], "stored boolean")


@query("SELECT * FROM (VALUES (2), (5)) t(i)")
def jdbc_savepoints(spark, d):
    """Of nested scopes, what is rolled back leaves the rest."""
    url = _store(spark)
    with tables.connection(spark, url) as conn:
        tables.execute(conn, "CREATE TABLE t (i INT)")
        with tables.scope(conn):
            tables.execute(conn, "INSERT INTO t VALUES (2)")
            with tables.scope(conn, commit=False):
                tables.execute(conn, "INSERT INTO t VALUES (3)")
            with tables.scope(conn):
                tables.execute(conn, "INSERT INTO t VALUES (5)")
        with tables.scope(conn, commit=False):
            tables.execute(conn, "INSERT INTO t VALUES (6)")
    return jdbc.read(spark, url, "t").withColumnRenamed("I", "i")


@query("SELECT * FROM customer")
def loader_jdbc(spark, d):
    url, file = _store(spark), f"{d.rstrip('/')}/customer.parquet"
    with contextlib.redirect_stdout(io.StringIO()):
        if cli.main([file, "--jdbc", url, "--table", "customer"], spark):
            raise RuntimeError("the loader has lost rows")
    return _as_before(jdbc.read(spark, url, "customer"), table(spark, d, "customer"))


@query("SELECT * FROM customer")
def loader_dump(spark, d):
    path, file = _shared(spark), f"{d.rstrip('/')}/customer.parquet"
    with contextlib.redirect_stdout(io.StringIO()):
        if cli.main([file, "--dump", path, "--compression", "lz4"], spark):
            raise RuntimeError("the loader has lost rows")
    return _as_before(read_dump(spark, path), table(spark, d, "customer"))
