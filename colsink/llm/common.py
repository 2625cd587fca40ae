"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import atexit
import math
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Spark's setting that has a query's shuffle files removed when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(df: DataFrame, col: str = "text") -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), as a long; no array is built."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_text(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes."""
    return F.crc32(F.encode(text, "UTF-8"))


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions the session asks shuffles to have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the session has in ``spark.checkpoint.dir``; only where that is unset and
    the session runs in one process, as in tests, a temporary folder takes its place.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="colsink-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


class Scratch:
    """Tables written into the shared folder to cut lineage.

    A table is written once by Spark's own committer (so that lost executors and
    repeated tasks do no harm) and then read back; its query's shuffle files go once it is
    written. ``drop`` removes a table early; what is left goes when the driver's Python
    ends, as results may read it until then.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/colsink-{label}-{uuid.uuid4().hex}"
        atexit.register(self._clear)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        conf = self.spark.conf
        before = conf.get(_CLEANUP)
        conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").options(**options).parquet(self.path(name))
        finally:
            conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        self._delete(self.path(name))

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def _clear(self) -> None:
        local = re.sub(r"^file:/*", "/", self.root)
        if local.startswith("/"):
            shutil.rmtree(local, ignore_errors=True)
        elif self.spark.sparkContext._jsc is not None:  # the session still runs
            self._delete(self.root)


def buckets_for(rows: int) -> int:
    """Buckets that a group's rows are numbered in: about the root of the table's rows, as a power of two.

    A hot group then leaves no more rows in a bucket than buckets in the group. It follows
    the data alone, so numbers don't depend on the session.
    """
    return 1 << max(0, math.ceil(math.log2(max(1, rows)) / 2))


def running_total(df: DataFrame, group: list[str], order: list[Column], salt: Column, value: Column, into: str, buckets: int | None = None) -> DataFrame:
    """Add ``into``: the total of ``value`` (a long) over the rows before this one in its group.

    Two levels, so that a group that holds most rows is still dealt over
    ``buckets`` tasks: rows are added up within (group, bucket), and the buckets'
    totals, partially aggregated, give each bucket its first number. ``salt``
    decides the bucket and must be deterministic. Group columns must not be null.
    """
    buckets = buckets or buckets_for(df.count())
    by = [*group, "_bucket"]
    dealt = df.withColumns({"_bucket": F.pmod(F.xxhash64(salt), F.lit(buckets)).cast("int"), "_value": value.cast("long")})
    totals = dealt.groupBy(*by).agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select(*by, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return local.join(firsts, by).withColumn(into, F.col("_first") + F.col("_local")).select(*df.columns, into)


def global_rank(df: DataFrame, group: list[str], order: list[Column], salt: Column, buckets: int | None = None) -> DataFrame:
    """Add ``rank``: a number of each row in its group, gapless from 0."""
    return running_total(df, group, order, salt, F.lit(1), "rank", buckets)


def never_null(col: Column) -> Column:
    """A string that stands for a value, also for null, so that plain equality can join it."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))
