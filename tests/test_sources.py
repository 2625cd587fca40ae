"""Column files, JDBC tables, scans, the loader, streams and metrics."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from colsink import cli
from colsink.metrics import STATES, StateTimes, counted, summed
from colsink.operators import wire
from colsink.operators.compression import unframed
from colsink.plans.types import ConversionError, TargetColumn
from colsink.sources import jdbc, scans, scripts, tables
from colsink.sources.column_files import dump_metrics, read_dump, read_manifest, register, write_dump
from colsink.sources.options import SinkOptions
from colsink.streaming import stream_dump


@pytest.fixture
def rows(spark):
    return spark.range(1000).select(
        "id", (F.col("id") % 2 == 0).alias("b"), (F.col("id") / 2).alias("f"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("é"), F.col("id") % 5)).alias("t")
    )


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize(
    "options",
    [{}, {"compression": "lz4"}, {"compression": "lz4:9", "batchsize": "100"}, {"backrefsize": "64k"}, {"backrefsize": "-1"}, {"batchsize": "300", "immediatecommit": "true"}, {"backrefsize": "1M", "batchsize": "77", "compression": "lz4"}],
)
def test_round_trip(spark, rows, tmp_path, options):
    path = str(tmp_path / "dump")
    write_dump(rows.repartition(3), path, **options)
    assert same(read_dump(spark, path), rows)
    assert same(read_dump(spark, path).select("t", "id"), rows.select("t", "id"))
    size = int(options.get("batchsize", 1000))
    assert all(0 < b["rows"] <= size for b in read_manifest(path)["batches"])
    metrics = dump_metrics(path)
    assert metrics["row_count"] == 1000 and metrics["upload_count"] == len(read_manifest(path)["batches"])


def test_layout(spark, tmp_path):
    path = tmp_path / "dump"
    df = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "i int, `odd name!` string").coalesce(1)
    write_dump(df, str(path), [TargetColumn.parse("i", "INT"), TargetColumn.parse("odd name!", "TEXT"), TargetColumn.parse("rest", "DATE")], backrefsize="-1", dbtable='"s"."t"')
    part = path / "part0" / "batch0"
    assert (part / "col0.i.bin").read_bytes().hex() == "010000000200000003000000"
    assert (part / "col1.odd~name~.bin").read_bytes() == b"one\0two\0three\0"
    assert 'INTO "s"."t"("i", "odd name!")' in (part / "copy.sql").read_text() and "ON CLIENT" in (part / "copy.sql").read_text()
    assert (path / "create.sql").read_text().startswith('CREATE TABLE "s"."t"') and '"rest" DATE' in (path / "create.sql").read_text()
    assert "RESTRICT" in (path / "truncate.sql").read_text() and "DROP TABLE" in (path / "drop.sql").read_text()
    assert not (path / ".writing").exists()
    assert read_dump(spark, str(path)).orderBy("i").collect() == [(1, "one", None), (2, "two", None), (3, "three", None)]


def test_lz4_files_have_whole_frames_for_every_batch(spark, tmp_path):
    path = tmp_path / "dump"
    write_dump(spark.range(1000).coalesce(1), str(path), batchsize="300", compression="lz4")
    files = sorted(path.glob("part0/batch*/col0.id.bin.lz4"))
    assert [len(unframed(f.read_bytes())) // 8 for f in files] == [300, 300, 300, 100]
    assert "ON 'lz4' CLIENT" in next(path.glob("part0/batch0/copy.sql")).read_text()


def test_save_modes(spark, rows, tmp_path):
    path = str(tmp_path / "dump")
    write_dump(rows, path)
    write_dump(rows.limit(10), path)
    assert read_dump(spark, path).count() == 1010
    write_dump(rows.limit(5), path, mode="overwrite")
    assert read_dump(spark, path).count() == 5
    narrow = spark.createDataFrame([(7,)], "id int")
    write_dump(narrow, path, mode="overwrite")
    assert read_dump(spark, path).schema.simpleString() == "struct<id:bigint>"
    write_dump(narrow, path, [TargetColumn.parse("id", "INT")], mode="overwrite")
    write_dump(narrow, path, mode="overwrite", truncate="true")
    assert read_dump(spark, path).schema.simpleString() == "struct<id:int>" and read_dump(spark, path).count() == 1
    with pytest.raises(ConversionError):
        write_dump(rows, path)
    with pytest.raises(Exception, match="(?i)mode"):
        write_dump(narrow, path, mode="error")


def scripted(path):
    """Rows of all files that the load scripts of a dump name, by statement; each file must exist and be named once."""
    import re

    named = []
    for script in Path(path).glob("part*/batch*/copy.sql"):
        text = script.read_text()
        files = re.findall("R'([^']+)'", text)
        named += files
        assert all(Path(f).exists() and Path(f).parent == script.parent for f in files)
    assert len(named) == len(set(named))
    return sorted(v for f in named if "col0" in f for v in wire.decode(Path(f).read_bytes(), TargetColumn.parse("id", "BIGINT")).to_pylist())


def test_scripts_load_the_dump(spark, tmp_path):
    """What the scripts would load is what the dump holds, after appends, an overwrite and immediate commits."""
    path = str(tmp_path / "dump")
    held = []
    for first, mode, options in ((0, "append", {}), (100, "append", {}), (200, "append", {"immediatecommit": "true"}), (300, "overwrite", {}), (400, "append", {}), (500, "overwrite", {"immediatecommit": "true"})):
        write_dump(spark.range(first, first + 50).repartition(2), path, mode=mode, batchsize="20", **options)
        held = ([] if mode == "overwrite" else held) + list(range(first, first + 50))
        assert scripted(path) == held == sorted(r["id"] for r in read_dump(spark, path).collect())


def failing(spark):
    """Rows whose write fails near its end, in one task."""
    return spark.range(0, 10_000).coalesce(1).select("id", F.when(F.col("id") == 9_500, F.lit("a\0b")).otherwise(F.lit("t")).alias("t"))


def test_immediate_commits_survive_a_failure(spark, tmp_path):
    path = str(tmp_path / "dump")
    with pytest.raises(Exception):
        write_dump(failing(spark), path, batchsize="100", immediatecommit="true")
    held = read_dump(spark, path).select("id").distinct().count()
    assert 0 < held < 10_000 and held % 100 == 0
    write_dump(failing(spark).where("id < 50"), path)
    assert read_dump(spark, path).select("id").distinct().count() == held and read_dump(spark, path).where("id < 50").count() >= 100


def test_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    """One writer's commit neither loses nor removes what another has written or is writing."""
    import pyarrow as pa

    from colsink.sources import column_files

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(column_files, "TaskContext", Task)
    path, columns = str(tmp_path / "dump"), [TargetColumn.parse("id", "BIGINT")]
    writers = [column_files.ColumnFileWriter(SinkOptions.parse({"path": path, "batchsize": "30"}), columns, columns, False) for _ in range(4)]
    done = [w.write(iter([pa.record_batch({"id": list(range(k * 100, k * 100 + 100))})])) for k, w in enumerate(writers)]
    writers[3].abort([])
    for w, d in list(zip(writers, done))[:3]:
        w.commit([d])
    assert sorted(r["id"] for r in read_dump(spark, path).collect()) == list(range(300)) == scripted(path)
    (Path(path) / ".writing" / "other").mkdir(parents=True)
    write_dump(spark.range(300, 310), path)
    assert (Path(path) / ".writing" / "other").exists() and read_dump(spark, path).count() == 310


def test_named_writes_are_committed_once(spark, tmp_path):
    path = str(tmp_path / "dump")
    for _ in range(3):
        write_dump(spark.range(5), path, writeid="one")
    write_dump(spark.range(5), path, writeid="two")
    assert read_dump(spark, path).count() == 10
    with pytest.raises(ValueError):
        SinkOptions.parse({"path": "x", "writeid": "../y"})


def test_columns_are_read_alone(spark, rows, tmp_path):
    path = tmp_path / "dump"
    write_dump(rows, str(path))
    for f in path.glob("part*/batch*/col1.*"):
        f.unlink()
    assert same(read_dump(spark, str(path), ["t", "id"]), rows.select("t", "id"))


def test_actions():
    table = {
        ("append", True, False, False): [],
        ("append", False, True, True): ["create"],
        ("overwrite", True, False, True): ["drop", "create"],
        ("overwrite", True, True, False): ["truncate restrict"],
        ("overwrite", True, True, True): ["truncate cascade"],
        ("overwrite", False, True, False): ["create"],
    }
    assert all(tables.actions(*k) == v for k, v in table.items())
    with pytest.raises(ValueError):
        tables.actions("ignore", True)


def test_a_failed_write_leaves_the_dump_as_it_was(spark, rows, tmp_path):
    path = tmp_path / "dump"
    write_dump(rows, str(path))
    before = read_manifest(str(path))
    wide = spark.range(100_000, 100_010).repartition(2).select("id", F.lit(True).alias("b"), F.lit(1.0).alias("f"), F.when(F.col("id") == 100_003, F.lit("a\0b")).alias("t"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception):
            write_dump(wide, str(path), mode=mode)
        assert read_manifest(str(path)) == before and same(read_dump(spark, str(path)), rows)
        assert not (path / ".writing").exists()


def test_overflow_policy(spark, tmp_path):
    df, target = spark.createDataFrame([(1,), (300,)], "x int"), [TargetColumn.parse("x", "TINYINT")]
    with pytest.raises(Exception, match="Value out of range"):
        write_dump(df, str(tmp_path / "a"), target)
    write_dump(df, str(tmp_path / "b"), target, allowoverflow="true")
    assert sorted(read_dump(spark, str(tmp_path / "b")).collect(), key=str) == [(1,), (None,)]


def test_empty_and_unconverted(spark, tmp_path):
    write_dump(spark.range(0), str(tmp_path / "a"))
    assert read_dump(spark, str(tmp_path / "a")).count() == 0
    register(spark)
    with pytest.raises(Exception, match="write_dump"):
        spark.createDataFrame([(1,)], "x int").write.format("colsink").mode("append").save(str(tmp_path / "b"))
    with pytest.raises(Exception, match="no dump"):
        read_dump(spark, str(tmp_path / "none")).schema


def test_dump_directory_options(spark, tmp_path):
    made = str(tmp_path / "d")
    write_dump(spark.range(3).coalesce(1), made, dumpdir=made, dumpprefix="/there", dumponserver="true")
    text = Path(made, "part0/batch0/copy.sql").read_text()
    assert "R'/there/part0/batch0/col0.id.bin'" in text and "ON SERVER" in text
    with pytest.raises(Exception, match="overwritten"):
        write_dump(spark.range(3), made, mode="overwrite", dumpdir=made)


@pytest.mark.parametrize(
    "bad",
    [{}, {"path": "x", "batchsize": "0"}, {"path": "x", "truncate": "maybe"}, {"dumpdir": "x", "immediatecommit": "true"}, {"path": "x", "dumpprefix": "y"}, {"path": "x", "dumponserver": "true"}, {"path": "x", "compression": "zip"}, {"path": "x", "backrefsize": "many"}, {"path": "x", "compression": "lz4", "serverfeatures": "backrefs"}, {"path": "x", "serverfeatures": "magic"}],
)
def test_bad_options(bad):
    with pytest.raises(ValueError):
        SinkOptions.parse(bad)


def test_option_defaults():
    made = SinkOptions.parse({"Path": "/x/"})
    assert (made.path, made.batch_size, made.null_on_overflow, made.backrefs, made.compression.level) == ("/x", None, False, 0, None)


def test_server_features():
    assert SinkOptions.parse({"path": "x", "serverfeatures": "lz4", "backrefsize": "64k"}).backrefs == -1
    assert SinkOptions.parse({"path": "x", "backrefsize": "64k"}).backrefs == 65536


def test_scripts():
    assert scripts.identifier('a"b') == '"a""b"' and scripts.literal("it's") == "R'it''s'"
    assert scripts.file_name(3, "a.b c_1") == "col3.a~b~c_1.bin"


URL = "jdbc:derby:memory:{};create=true"


def test_jdbc_modes(spark, tmp_path):
    url = URL.format("modes")
    df = spark.createDataFrame([(1, "a")], "I int, T string")
    assert jdbc.probe(spark, url, "foo") is None
    jdbc.write(df, url, "foo")
    assert [(c.name, c.kind) for c in jdbc.probe(spark, url, "foo")] == [("I", "BIGINT"), ("T", "CLOB")]
    jdbc.write(df, url, "foo")
    assert jdbc.read(spark, url, "foo").count() == 2
    jdbc.write(df, url, "foo", "overwrite", truncate=True)
    jdbc.write(df, url, "foo", "ignore")
    assert jdbc.read(spark, url, "foo").count() == 1
    with pytest.raises(ValueError, match="exists"):
        jdbc.write(df, url, "foo", "error")
    with tables.connection(spark, url) as conn:
        tables.execute(conn, "CREATE TABLE fk (i INT NOT NULL PRIMARY KEY)")
        tables.execute(conn, "CREATE TABLE ref (i INT REFERENCES fk)")
    keys = spark.createDataFrame([(5,)], "I int")
    jdbc.write(keys, url, "fk")
    with pytest.raises(Exception):
        jdbc.write(keys, url, "fk", "overwrite")
    assert jdbc.read(spark, url, "fk").collect() == [(5,)]


def test_jdbc_checks_values(spark):
    url = URL.format("checks")
    with tables.connection(spark, url) as conn:
        tables.execute(conn, 'CREATE TABLE small (x SMALLINT, d DECIMAL(4,1))')
    df = spark.createDataFrame([(1, None), (40_000, None)], "X int, D decimal(4,1)").coalesce(1)  # each task commits by itself
    with pytest.raises(Exception, match="Value out of range"):
        jdbc.write(df, url, "small")
    jdbc.write(df, url, "small", null_on_overflow=True)
    assert sorted((r[0] for r in jdbc.read(spark, url, "small").collect()), key=str) == [1, None]
    with pytest.raises(ConversionError):
        jdbc.write(spark.createDataFrame([("a",)], "X string"), url, "small")


def test_jdbc_reads(spark):
    url = URL.format("reads")
    jdbc.write(spark.range(100).select(F.col("id").cast("int").alias("I"), (F.col("id") % 10).alias("N")), url, "foo")
    part = jdbc.read(spark, url, "foo", partition=("I", "0", "100", 4))
    assert part.rdd.getNumPartitions() == 4 and part.select("I").distinct().count() == 100
    typed = jdbc.read(spark, url, "foo", types={"N": "TINYINT"})
    assert typed.schema["N"].dataType.simpleString() == "tinyint"
    plan = jdbc.read(spark, url, "foo").where("I = 7")._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(I), *EqualTo(I,7)]" in plan
    jdbc.catalog(spark, "store", url)
    assert spark.sql("SELECT I FROM store.APP.FOO WHERE I > 90 ORDER BY I LIMIT 1 OFFSET 1").collect() == [(92,)]


def test_stores():
    assert jdbc.store_of("jdbc:derby:memory:x") is jdbc.DERBY and jdbc.store_of("jdbc:other://h/db") is jdbc.STANDARD
    with pytest.raises(ValueError):
        jdbc.store_of("http://x")


def test_scopes(spark):
    url = URL.format("scopes")
    with tables.connection(spark, url) as conn:
        tables.execute(conn, "CREATE TABLE t (i INT)")
        with pytest.raises(KeyError), tables.scope(conn):
            tables.execute(conn, "INSERT INTO t VALUES (1)")
            raise KeyError
        with tables.scope(conn):
            tables.execute(conn, "INSERT INTO t VALUES (2)")
            with tables.scope(conn, commit=False):
                tables.execute(conn, "INSERT INTO t VALUES (3)")
            with pytest.raises(KeyError), tables.scope(conn):
                tables.execute(conn, "INSERT INTO t VALUES (4)")
                raise KeyError
            with tables.scope(conn):
                tables.execute(conn, "INSERT INTO t VALUES (5)")
        with tables.scope(conn, commit=False):
            tables.execute(conn, "INSERT INTO t VALUES (6)")
        assert conn.getAutoCommit()
    assert sorted(r[0] for r in jdbc.read(spark, url, "t").collect()) == [2, 5]


def test_scans(spark, tmp_path):
    spark.range(10).write.orc(str(tmp_path / "x.orc"))
    assert scans.read_file(spark, str(tmp_path / "x.orc")).count() == 10
    with pytest.raises(ValueError):
        scans.read_file(spark, "x.xls")
    assert scans.probe(spark.range(10)).count() == 0
    df = spark.range(100)
    at = df.select(scans.stride(F.col("id"), 20, 60, 4).alias("s")).groupBy("s").count()
    assert sorted(tuple(r) for r in at.collect()) == [(0, 30), (1, 10), (2, 10), (3, 50)]
    assert spark.createDataFrame([(None,)], "v long").select(scans.stride(F.col("v"), 0, 10, 2)).collect() == [(0,)]
    assert scans.in_strides(df, "id", 0, 100, 4).count() == 100


def test_filters_and_columns_reach_the_files(spark, tiny):
    plan = spark.read.parquet(f"{tiny}/orders.parquet").where("o_totalprice > 1000").select("o_orderkey")._jdf.queryExecution().toString()
    assert "GreaterThan(o_totalprice,1000.0)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_loader(spark, tiny, tmp_path, capsys):
    source = f"{tiny}/orders.parquet"
    assert cli.main([source, "--dump", str(tmp_path / "d"), "--compression", "lz4"], spark) == 0
    assert cli.main([source, "--jdbc", URL.format("cli"), "--table", "o"], spark) == 0
    assert "verify" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main([source], spark)


def test_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(50).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    query = stream_dump(stream, str(tmp_path / "out"), str(tmp_path / "state"), once=True)
    query.awaitTermination(60)
    assert read_dump(spark, str(tmp_path / "out")).count() == 50


def test_metrics(spark):
    now = iter(range(0, 10**9, 10**6))
    times = StateTimes(lambda: next(now))
    times.enter("collecting")
    times.enter("uploading")
    times.leave()
    times.rows, times.uploads = 5, 1
    made = times.totals()
    assert made["millis_total"] == sum(made[f"millis_{s}"] for s in STATES) and made["row_count"] == 5
    assert summed([made, made])["row_count"] == 10
    with pytest.raises(ValueError):
        times.enter("resting")
    df, seen = counted(spark.range(7))
    df.collect()
    assert seen.get == {"row_count": 7}


def test_manifest_is_plain_json(spark, tmp_path):
    write_dump(spark.range(3), str(tmp_path / "d"))
    with open(tmp_path / "d" / "manifest.json") as f:
        assert json.load(f)["columns"] == [["id", "BIGINT"]]
    assert os.listdir(tmp_path / "d")
    assert wire.decode(b"", TargetColumn.parse("x", "INT")).to_pylist() == []
