"""Load a file into a dump or a JDBC table and verify the row count.

    python -m colsink.cli FILE --dump DIR [--batchsize N] [--compression lz4]
    python -m colsink.cli FILE --jdbc URL --table NAME
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from colsink import __version__
from colsink.sources import jdbc, scans
from colsink.sources.column_files import read_dump, write_dump


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 where as many rows are stored as were read."""
    parser = argparse.ArgumentParser(prog="colsink", description="Load a file into column files or a table.")
    parser.add_argument("file")
    parser.add_argument("--format", choices=scans.FORMATS)
    parser.add_argument("--dump")
    parser.add_argument("--jdbc")
    parser.add_argument("--table", default="loaded")
    parser.add_argument("--batchsize", type=int, default=10_000)
    parser.add_argument("--compression", default="none")
    parser.add_argument("--allowoverflow", action="store_true")
    parser.add_argument("--version", action="version", version=__version__)
    given = parser.parse_args(args)
    if bool(given.dump) == bool(given.jdbc):
        parser.error("give either --dump or --jdbc")
    spark = spark or SparkSession.builder.appName("colsink").getOrCreate()
    began = time.perf_counter()

    def phase(name: str, rows: int | None = None) -> None:
        nonlocal began
        now = time.perf_counter()
        print(f"{name}: {now - began:.2f} s" + (f", {rows} rows" if rows is not None else ""))
        began = now

    df = scans.read_file(spark, given.file, given.format)
    expected = df.count()
    phase("read", expected)
    if given.dump:
        write_dump(df, given.dump, mode="overwrite", batchsize=str(given.batchsize), compression=given.compression, allowoverflow=str(given.allowoverflow).lower(), dbtable=given.table)
        phase("load")
        stored = read_dump(spark, given.dump, df.columns[:1]).count()
    else:
        jdbc.write(df, given.jdbc, given.table, "overwrite", null_on_overflow=given.allowoverflow, batch_size=given.batchsize)
        phase("load")
        stored = jdbc.read(spark, given.jdbc, given.table).count()
    phase("verify", stored)
    if stored != expected:
        print(f"{expected} rows were read and {stored} are stored", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
