"""Every query of the catalogue against its SQL on the smallest tables."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from colsink.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(tiny):
    made = duckdb.connect()
    made.execute("SET TimeZone = 'UTC'")
    for f in Path(tiny).glob("*.parquet"):
        made.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return made


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return str(value) if isinstance(value, (Decimal, dt.datetime, dt.date)) else value


def sorted_rows(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def agree(spark, duck, folder, query, sql):
    df = query(spark, folder)
    names = sorted(df.columns)
    found = duck.execute(sql)
    given = [d[0] for d in found.description]
    assert sorted(given) == names
    assert sorted_rows(df.select(*names).collect()) == sorted_rows([r[given.index(n)] for n in names] for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, tiny, name):
    agree(spark, duck, tiny, QUERIES[name], ORACLE_SQL[name])


def test_entry_points(spark, tiny):
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() == 1


def test_jdbc_queries_where_executors_are_other_processes(duck, tiny, tmp_path):
    """In a session of two executors; the embedded store lives in the driver's process."""
    import os
    import subprocess
    import sys

    import pyspark

    home = tmp_path / "home"
    (home / "work").mkdir(parents=True)
    for p in Path(pyspark.__path__[0]).iterdir():  # executors' logs go to work in Spark's home
        if p.name != "work":
            (home / p.name).symlink_to(p)
    names = [n for n in sorted(QUERIES) if "jdbc" in n]
    code = f"""
import pickle
from pyspark.sql import SparkSession
conf = {{"spark.master": "local-cluster[2,1,700]", "spark.executor.memory": "700m", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false",
    "spark.checkpoint.dir": "{(tmp_path / "shared").as_uri()}", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "2"}}
spark = SparkSession.builder.config(map=conf).getOrCreate()
import __spark_entry__
found = {{}}
for name in {names!r}:
    df = __spark_entry__.queries()[name](spark, {tiny!r})
    found[name] = df.columns, [tuple(r) for r in df.collect()]
pickle.dump(found, open({str(tmp_path / "found")!r}, "wb"))
spark.stop()
"""
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
    root = str(Path(entry.__file__).resolve().parent)
    done = subprocess.run([sys.executable, "-c", code], env=env | {"PYTHONPATH": root}, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    import pickle

    for name, (columns, rows) in pickle.loads((tmp_path / "found").read_bytes()).items():
        made = duck.execute(ORACLE_SQL[name])
        given = [d[0] for d in made.description]
        order = [columns.index(n) for n in given]
        assert sorted(columns) == sorted(given), name
        assert sorted_rows([r[i] for i in order] for r in rows) == sorted_rows(made.fetchall()), name
    assert len(names) == 15
