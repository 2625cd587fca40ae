"""SQL text of a dump: load statements and table definitions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from colsink.plans.types import TargetColumn


def identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def literal(text: str) -> str:
    """A string literal in which only quotes are special."""
    return "R'" + text.replace("'", "''") + "'"


def file_name(index: int, column: str, suffix: str = "") -> str:
    """Of a column file; characters other than letters, digits and _ become ~."""
    return f"col{index}.{re.sub(r'[^A-Za-z0-9_]', '~', column)}.bin{suffix}"


def load(table: str, columns: Sequence[TargetColumn], files: Sequence[str], rows: int, lz4: bool = False, on_server: bool = False, label: str = "colsink") -> str:
    """The statement that loads one batch of column files."""
    names = ", ".join(identifier(c.name) for c in columns)
    where = f"ON {repr('lz4') + ' ' if lz4 else ''}{'SERVER' if on_server else 'CLIENT'}"
    return f"/* {label}: {rows} rows */\nCOPY LITTLE ENDIAN BINARY INTO {table}({names})\nFROM {', '.join(map(literal, files))}\n{where};\n"


def create(table: str, columns: Sequence[TargetColumn]) -> str:
    inside = ",\n".join(f"  {identifier(c.name)} {c.sql}" for c in columns)
    return f"CREATE TABLE {table} (\n{inside}\n);\n"


def drop(table: str) -> str:
    return f"DROP TABLE {table};\n"


def truncate(table: str, cascade: bool = False) -> str:
    return f"TRUNCATE TABLE {table} {'CASCADE' if cascade else 'RESTRICT'};\n"
