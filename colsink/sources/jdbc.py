"""JDBC tables: typed and partitioned reads, catalogs, and writes in every save mode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsink.plans.conversion import plan
from colsink.plans.types import TargetColumn, sql_type, spark_type, table_columns
from colsink.sources import embedded, tables


@dataclass(frozen=True)
class Store:
    """How one kind of server differs: its URLs, its names for types, and what it can do."""

    prefixes: tuple[str, ...]
    driver: str | None = None
    types: Mapping[str, str] = field(default_factory=dict)
    limit: bool = True
    offset: bool = True
    cascades: bool = False
    embedded: bool = False  # lives in the driver's process

    def handles(self, url: str) -> bool:
        return url.lower().startswith(self.prefixes)

    def type_name(self, kind: T.DataType) -> str:
        made = sql_type(kind)
        return self.types.get(made, made)


#: The embedded engine that comes with Spark. It has no zoned timestamps; limits and offsets
#: are left to Spark, as what is pushed down to it loses the limit.
DERBY = Store(("jdbc:derby:",), "org.apache.derby.iapi.jdbc.AutoloadedDriver", {"TIMESTAMP WITH TIME ZONE": "TIMESTAMP"}, limit=False, offset=False, embedded=True)
#: Any other server: standard types.
STANDARD = Store(("jdbc:",))
STORES: list[Store] = [DERBY, STANDARD]


def store_of(url: str) -> Store:
    """The first registered store whose prefix the URL has."""
    for store in STORES:
        if store.handles(url):
            return store
    raise ValueError(f"no store handles {url!r}")


def _reachable(spark: SparkSession, url: str) -> str:
    """The URL by which tasks read: of a copy, where the store's process is not theirs."""
    alone = store_of(url).embedded and not embedded.one_process(spark) and not url.startswith("jdbc:derby:jar:")
    return embedded.snapshot(spark, url) if alone else url


def read(
    spark: SparkSession,
    url: str,
    table: str,
    types: Mapping[str, str] | None = None,
    partition: tuple[str, str, str, int] | None = None,
    init: str | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table, or a query in parentheses with an alias.

    ``types`` gives columns the Spark types of SQL ones (as a projection over the scan,
    so that filters and limits still reach the server). ``partition`` is (column, lower,
    upper, number): strides read in parallel. ``init`` runs at the start of each session.
    Where tasks have other processes than an embedded store, they read it as it is now.
    """
    store, url = store_of(url), _reachable(spark, url)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    reader = reader.option("pushDownLimit", store.limit).option("pushDownOffset", store.offset)
    if store.driver:
        reader = reader.option("driver", store.driver)
    if partition:
        for name, value in zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), partition):
            reader = reader.option(name, value)
    if init:
        reader = reader.option("sessionInitStatement", init)
    rows = reader.load()
    named = {k: spark_type(v) for k, v in (types or {}).items()}
    return rows.select(*[F.col(f"`{c}`").cast(named[c]).alias(c) if c in named else F.col(f"`{c}`") for c in rows.columns])


def probe(spark: SparkSession, url: str, table: str) -> list[TargetColumn] | None:
    """A table's columns without reading rows; None where it doesn't exist."""
    with tables.connection(spark, url) as conn:
        return tables.columns(conn, table)


def catalog(spark: SparkSession, name: str, url: str) -> None:
    """Make a server's tables known to SQL as ``name.schema.table``; an embedded store's as ``read`` has them."""
    base = f"spark.sql.catalog.{name}"
    spark.conf.set(base, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    store, url = store_of(url), _reachable(spark, url)
    options = {"url": url, "pushDownLimit": store.limit, "pushDownOffset": store.offset} | ({"driver": store.driver} if store.driver else {})
    for option, value in options.items():
        spark.conf.set(f"{base}.{option}", str(value).lower() if isinstance(value, bool) else value)


def column_types(schema: T.StructType, url: str) -> str:
    """Value of ``createTableColumnTypes`` for a new table."""
    # Spark parses these as its own types, so only what it knows can be named
    known = {"SMALLINT", "INTEGER", "BIGINT", "BOOLEAN", "DOUBLE", "REAL", "DATE", "TIMESTAMP"}
    made = [(f.name, store_of(url).type_name(f.dataType)) for f in schema]
    return ", ".join(f"`{n}` {t}" for n, t in made if t in known or t.startswith("DECIMAL"))


def write(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    truncate: bool = False,
    cascade: bool = False,
    null_on_overflow: bool = False,
    batch_size: int = 10_000,
    targets: Sequence[TargetColumn] | None = None,
) -> None:
    """Convert to the table's columns and insert the rows.

    ``append`` creates a missing table; ``overwrite`` drops and creates, or truncates;
    ``error`` and ``ignore`` do nothing more where the table exists. The table is made
    ready in one transaction on the driver before any task runs.
    """
    spark, store = df.sparkSession, store_of(url)
    with tables.connection(spark, url) as conn:
        exists = tables.columns(conn, table) is not None
        if mode in ("error", "errorifexists") and exists:
            raise ValueError(f"table {table} exists")
        if mode == "ignore" and exists:
            return
        made = list(targets) if targets else table_columns(df.schema)
        ready = tables.prepare(conn, table, made, "overwrite" if mode == "overwrite" else "append", truncate, cascade, dict(store.types))
    out = plan(df, ready, null_on_overflow)
    if store.embedded and not embedded.one_process(spark):
        embedded.insert(out, url, table, store.driver, batch_size)
        return
    writer = out.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    (writer.option("driver", store.driver) if store.driver else writer).mode("append").save()
