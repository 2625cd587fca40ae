"""Options of the column-file sink, checked before any job starts."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from colsink.operators.backref import memory_size
from colsink.operators.compression import Compression


def _flag(options: Mapping[str, str], name: str, default: bool = False) -> bool:
    value = str(options.get(name, default)).strip().lower()
    if value not in ("true", "false"):
        raise ValueError(f"option {name} must be true or false, not {value!r}")
    return value == "true"


@dataclass(frozen=True)
class SinkOptions:
    """``path``: the dump's folder. ``table``: its name in the scripts, quoted by the caller.

    ``serverfeatures`` names what the loading server can do, of ``backrefs`` and ``lz4``:
    without the first texts are written plainly, without the second compression is refused.
    ``writeid`` names a write, so that the same write is committed once however often it is repeated.
    """

    path: str
    table: str = "dump"
    target: str | None = None
    batch_size: int | None = None
    null_on_overflow: bool = False
    immediate_commit: bool = False
    prefix: str | None = None
    on_server: bool = False
    compression: Compression = Compression()
    backrefs: int = 0
    truncate: bool = False
    cascade: bool = False
    write_id: str | None = None

    @staticmethod
    def parse(options: Mapping[str, str]) -> SinkOptions:
        """From a data source's options; names are taken in any case."""
        given = {k.lower(): v for k, v in options.items()}
        path = given.get("path") or given.get("dumpdir")
        if not path:
            raise ValueError("option path (or dumpdir) is required")
        size = given.get("batchsize")
        if size is not None and (not str(size).strip().isdigit() or int(size) < 1):
            raise ValueError("option batchsize must be a whole number of 1 or more")
        able = {x.strip().lower() for x in given.get("serverfeatures", "backrefs,lz4").split(",") if x.strip()}
        if unknown := able - {"backrefs", "lz4"}:
            raise ValueError(f"unknown server feature {', '.join(sorted(unknown))}")
        made = SinkOptions(
            path=path.rstrip("/"),
            table=given.get("dbtable", "dump"),
            target=given.get("target"),
            batch_size=int(size) if size is not None else None,
            null_on_overflow=_flag(given, "allowoverflow"),
            immediate_commit=_flag(given, "immediatecommit"),
            prefix=given.get("dumpprefix"),
            on_server=_flag(given, "dumponserver"),
            compression=Compression.parse(given.get("compression", "none")),
            backrefs=memory_size(given.get("backrefsize", "0")) if "backrefs" in able else -1,
            truncate=_flag(given, "truncate"),
            cascade=_flag(given, "cascadetruncate"),
            write_id=given.get("writeid"),
        )
        if made.write_id is not None and not re.fullmatch(r"[A-Za-z0-9._-]+", made.write_id):
            raise ValueError("option writeid must consist of letters, digits, points and dashes")
        if made.compression.level is not None and "lz4" not in able:
            raise ValueError("the server can't load compressed files")
        if made.immediate_commit and "dumpdir" in given:
            raise ValueError("dumpdir and immediatecommit exclude each other")
        if (made.prefix is not None or made.on_server) and "dumpdir" not in given:
            raise ValueError("dumpprefix and dumponserver need dumpdir")
        return made
