"""Stored tables over JDBC: definition, transactions, and what each save mode does to them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

from colsink.plans.types import TargetColumn
from colsink.sources.scripts import identifier

APPEND, OVERWRITE = "append", "overwrite"


def actions(mode: str, exists: bool, truncate: bool = False, cascade: bool = False) -> list[str]:
    """What a write does to the table before rows are added."""
    if mode not in (APPEND, OVERWRITE):
        raise ValueError(f"save mode {mode!r} is not supported; use append or overwrite")
    if not exists:
        return ["create"]
    if mode == APPEND:
        return []
    if truncate:
        return ["truncate cascade" if cascade else "truncate restrict"]
    return ["drop", "create"]


@contextmanager
def connection(spark: SparkSession, url: str, driver: str | None = None) -> Iterator:
    """A JDBC connection of the driver's JVM, closed at the end."""
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(driver).getDeclaredConstructor(None).newInstance(None)
    made = jvm.java.sql.DriverManager.getConnection(url)
    try:
        yield made
    finally:
        made.close()


@contextmanager
def scope(conn, commit: bool = True) -> Iterator[None]:
    """All or nothing: a transaction, or a savepoint where one is already open.

    Without ``commit``, or after an error, everything inside is rolled back.
    """
    outermost = conn.getAutoCommit()
    point = None
    if outermost:
        conn.setAutoCommit(False)
    else:
        point = conn.setSavepoint()
    try:
        yield
    except BaseException:
        conn.rollback() if point is None else conn.rollback(point)
        raise
    else:
        if not commit:
            conn.rollback() if point is None else conn.rollback(point)
        elif point is None:
            conn.commit()
        else:
            conn.releaseSavepoint(point)
    finally:
        if outermost:
            conn.setAutoCommit(True)


def execute(conn, sql: str) -> None:
    statement = conn.createStatement()
    try:
        statement.execute(sql)
    finally:
        statement.close()


def columns(conn, table: str) -> list[TargetColumn] | None:
    """The table's columns by a query without rows, or None where there is no such table."""
    statement = conn.createStatement()
    try:
        try:
            found = statement.executeQuery(f"SELECT * FROM {table} WHERE 1 = 0")
        except Exception as e:  # the JVM's error: only a missing table is expected
            state = getattr(getattr(e, "java_exception", None), "getSQLState", lambda: "")()
            if state in ("42X05", "42Y07", "42S02"):
                return None
            raise
        meta = found.getMetaData()
        out = []
        for i in range(1, meta.getColumnCount() + 1):
            name, kind = meta.getColumnName(i), meta.getColumnTypeName(i)
            digits = f"({meta.getPrecision(i)},{meta.getScale(i)})" if kind.upper() in ("DECIMAL", "NUMERIC") else ""
            out.append(TargetColumn.parse(name, kind + digits))
        found.close()
        return out
    finally:
        statement.close()


def create(conn, table: str, made: Sequence[TargetColumn], types: dict[str, str] | None = None) -> None:
    """``types`` names a store's own types for SQL ones it lacks."""
    inside = ", ".join(f"{identifier(c.name)} {(types or {}).get(c.sql, c.sql)}" for c in made)
    execute(conn, f"CREATE TABLE {table} ({inside})")


def drop(conn, table: str) -> None:
    execute(conn, f"DROP TABLE {table}")


def truncate(conn, table: str, cascade: bool = False, query: str = "TRUNCATE TABLE {table}") -> None:
    execute(conn, query.format(table=table) + (" CASCADE" if cascade else ""))


def prepare(conn, table: str, made: Sequence[TargetColumn], mode: str, truncate_only: bool = False, cascade: bool = False, types: dict[str, str] | None = None) -> list[TargetColumn]:
    """Do what the mode asks for in one scope; the columns rows must then be converted to."""
    with scope(conn):
        before = columns(conn, table)
        todo = actions(mode, before is not None, truncate_only, cascade)
        for action in todo:
            if action == "drop":
                drop(conn, table)
            elif action == "create":
                create(conn, table, made, types)
            else:
                truncate(conn, table, action.endswith("cascade"))
        return list(made) if "create" in todo else before
