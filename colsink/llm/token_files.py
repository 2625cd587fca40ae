"""Token ids as Parquet list columns that can be read in parts.

A file row is one document: doc_id, ids (a list), n_tokens, part, first_in_part. Files are
range-partitioned and sorted by doc_id, so row groups and pages cover narrow id ranges.
Ids are dictionary encoded (a vocabulary fits a dictionary page, codes take up to 16
bits); the sorted integer columns have no dictionary and are delta encoded. Row groups
and pages have set sizes, and the column and offset indexes that the writer adds let a
reader take only the pages of the ids it asks for. Metadata columns are read without
touching the tokens.

Spark's own writer and committer are used, so any store that Spark reaches will do and
a lost executor's task is written anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colsink.llm.common import Scratch, read_table, shuffle_width
from colsink.llm.tokenizing import BYTE_BPE, END_ID, crc32_ids, encoder, id_lists, small_batches, texts_in_parts, vocabulary

#: Pieces a worker keeps: fewer than elsewhere, as the sorted texts take memory beside it.
CACHED = 600_000

SCHEMA = "doc_id long, ids array<int>, n_tokens int, part int, first_in_part long"


def write_options(row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2_000, codec: str = "snappy") -> dict[str, str]:
    """Options of the Parquet writer: encodings, row groups and pages."""
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "n_tokens", "part", "first_in_part")}
    return plain | {
        "parquet.enable.dictionary": "true",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.page.write-checksum.enabled": "true",
        "compression": codec,
    }


def tokenized(docs: DataFrame, tokenizer: str, partitions: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of the file format in ascending order of the key; a null text has the end id alone.

    Repeated keys follow each other, ordered by text.
    """
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        first = 0
        for batch in batches:
            for at, texts in texts_in_parts(batch.column(1)):
                ids = [x + end for x in encoder(tokenizer, CACHED).encode(texts)]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = first + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(ids)), id_lists(ids), pa.array(sizes.astype(np.int32)), pa.array(np.full(len(ids), part, np.int32)), pa.array(ends - sizes)],
                    names=["doc_id", "ids", "n_tokens", "part", "first_in_part"],
                )
                first = int(ends[-1])

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, partitions: int | None = None, **sizes) -> None:
    """Encode ``docs`` and write the files below ``path``."""
    n = partitions or shuffle_width(docs.sparkSession)
    tokenized(docs, tokenizer, n).write.mode("overwrite").options(**write_options(**sizes)).parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The files' rows, those with ``first <= doc_id <= last`` where given.

    Bounds are pushed to the files: row groups by their statistics, pages by the indexes.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows


def with_start(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``start``: the ids of all documents before, from the parts' totals.

    The totals come from the metadata columns alone, one number a part.
    """
    spark = rows.sparkSession
    totals = read_tokens(spark, path).groupBy("part").agg(F.max(F.col("first_in_part") + F.col("n_tokens")).alias("n")).collect()
    firsts, at = [], 0
    for r in sorted(totals, key=lambda r: r["part"]):
        firsts.append((r["part"], at))
        at += r["n"]
    table = F.broadcast(spark.createDataFrame(firsts, "part int, before long"))  # as many rows as files
    return rows.join(table, "part").withColumn("start", F.col("before") + F.col("first_in_part")).drop("before")


def op6_token_lists(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded, written in ascending doc_id order and read back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = Scratch(spark, "tokens").path("files")
    write_tokens(docs, path, vocabulary(BYTE_BPE))
    rows = with_start(read_tokens(spark, path), path)
    return rows.select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), crc32_ids(F.col("ids")).alias("ids_crc32"))
