"""The ``colsink`` data source: a DataFrame as little-endian column files, and back.

Layout below the dump's folder:

    manifest.json                      table, columns and generation; replaced as a whole
    commits/<generation>/<write>.json  batches and metrics of one write
    create.sql drop.sql truncate.sql   table definition
    part<N>[.<write>]/batch<K>/        one batch of one task
        col<i>.<name>.bin[.lz4] copy.sql

Tasks write into a folder of their own write and attempt. The driver's commit moves the
folders of the attempts that count into place and then adds one file that names them, so
readers see all of a write or nothing, and writers that append at the same time don't
touch each other's files. An overwrite begins a generation and its commit replaces the
manifest. An abort removes the write's own attempts. With ``immediatecommit`` each batch
is published by its task as soon as it is full, in a commit file of its own, and stays if the
job fails later; when the job succeeds, the write's own file takes their place. An overwrite of
that kind begins its generation before its tasks run. A task holds one Arrow batch and
the back-reference memory at a time.

Paths are file-system URIs that pyarrow opens, or plain paths on a shared folder.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from colsink.metrics import StateTimes, summed
from colsink.operators import backref, wire
from colsink.operators.compression import unframed
from colsink.plans.conversion import plan
from colsink.plans.types import STRINGS, ConversionError, TargetColumn, stored_schema, table_columns
from colsink.sources import scripts
from colsink.sources.options import SinkOptions

FORMAT = "colsink"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _write(store: fs.FileSystem, path: str, data: bytes) -> None:
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)


def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def target_text(columns: Sequence[TargetColumn]) -> str:
    return json.dumps([[c.name, c.sql] for c in columns])


def target_columns(text: str) -> list[TargetColumn]:
    return [TargetColumn.parse(n, t) for n, t in json.loads(text)]


def _read_json(store: fs.FileSystem, path: str) -> dict | None:
    if not _exists(store, path):
        return None
    with store.open_input_stream(path) as f:
        return json.loads(f.read())


def _publish(store: fs.FileSystem, path: str, content: dict) -> None:
    """Write a file that others see whole or not at all."""
    new = f"{path}.{uuid.uuid4().hex}.new"
    _write(store, new, json.dumps(content).encode())
    store.move(new, path)


def read_manifest(path: str) -> dict | None:
    """What a dump holds, or None where there is none: its definition with the batches and metrics of all commits."""
    store, root = _open(path)
    held = _read_json(store, f"{root}/manifest.json")
    if held is None:
        return None
    folder = fs.FileSelector(f"{root}/commits/{held['generation']}", allow_not_found=True)
    names = sorted(f.base_name.removesuffix(".json") for f in store.get_file_info(folder) if f.base_name.endswith(".json"))
    whole = {n for n in names if "@" not in n}
    batches, metrics = [], {}
    for n in names:
        if n in whole or n.split("@")[0] not in whole:  # a whole write's file stands for those of its batches
            commit = _read_json(store, f"{root}/commits/{held['generation']}/{n}.json")
            batches += commit["batches"]
            metrics = summed([metrics, commit["metrics"]])
    return held | {"batches": batches, "metrics": metrics}


@dataclass
class Batch(InputPartition):
    """One batch of column files: its folder below the dump's, its rows and its files."""

    folder: str
    rows: int
    files: list[str]
    lz4: bool
    backrefs: bool


@dataclass
class TaskDone(WriterCommitMessage):
    """A task's attempt: where it wrote, its batches and its times."""

    part: int
    attempt: str
    batches: list[Batch] = field(default_factory=list)
    metrics: dict[str, int] = field(default_factory=dict)


class ColumnFileWriter(DataSourceArrowWriter):
    """Writes record batches whose columns already have the target's types."""

    def __init__(self, options: SinkOptions, columns: Sequence[TargetColumn], all_columns: Sequence[TargetColumn], overwrite: bool):
        self.options, self.columns, self.all_columns, self.overwrite = options, list(columns), list(all_columns), overwrite
        self.write_id = options.write_id or f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
        store, root = _open(options.path)
        before = _read_json(store, f"{root}/manifest.json")
        self.suffix = f".{self.write_id}" if before else ""
        self.generation = before["generation"] if before and not overwrite else self.write_id if overwrite else "first"
        if options.immediate_commit:
            old = read_manifest(options.path) if overwrite else None
            self._define(store, root, before)
            self._remove(store, root, old)

    def _define(self, store: fs.FileSystem, root: str, before: dict | None) -> None:
        """The table's scripts and the manifest, where there are none or others."""
        if before and before["generation"] == self.generation:
            return
        table = self.options.table
        store.create_dir(f"{root}/commits/{self.generation}")
        for name, text in (("create", scripts.create(table, self.all_columns)), ("drop", scripts.drop(table)), ("truncate", scripts.truncate(table, self.options.cascade))):
            _write(store, f"{root}/{name}.sql", text.encode())
        _publish(store, f"{root}/manifest.json", {"columns": [[c.name, c.sql] for c in self.all_columns], "written": [c.name for c in self.columns], "table": table, "generation": self.generation})

    def _remove(self, store: fs.FileSystem, root: str, old: dict | None) -> None:
        """What an overwrite has replaced: the folders and commits of the generation before."""
        if old and old["generation"] != self.generation:
            for folder in {b["folder"].split("/")[0] for b in old["batches"]} | {f"commits/{old['generation']}"}:
                if _exists(store, f"{root}/{folder}"):
                    store.delete_dir(f"{root}/{folder}")

    # on executors

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskDone:
        store, root = _open(self.options.path)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        base = f"{root}/.writing/{self.write_id}/{attempt}"
        times, done = StateTimes(), TaskDone(part, attempt)
        open_batch: _OpenBatch | None = None
        times.enter("collecting")
        for records in iterator:
            at = 0
            while at < records.num_rows:
                if open_batch is None:
                    open_batch = _OpenBatch(store, f"{base}/batch{len(done.batches)}", self.columns, self.options)
                room = records.num_rows - at if self.options.batch_size is None else min(records.num_rows - at, self.options.batch_size - open_batch.rows)
                open_batch.add(records.slice(at, room))
                at += room
                if open_batch.rows == self.options.batch_size:
                    self._close(store, root, open_batch, done, times)
                    open_batch = None
        if open_batch is not None:
            self._close(store, root, open_batch, done, times)
        times.leave()
        done.metrics = times.totals()
        return done

    def _close(self, store: fs.FileSystem, root: str, batch: _OpenBatch, done: TaskDone, times: StateTimes) -> None:
        times.enter("uploading")
        options, k = self.options, len(done.batches)
        place = f"part{done.part}-{done.attempt}" if options.immediate_commit else f"part{done.part}{self.suffix}"
        files = batch.close(f"{place}/batch{k}")
        made = Batch(f"{place}/batch{k}", batch.rows, files, options.compression.level is not None, options.backrefs >= 0)
        if options.immediate_commit:
            times.enter("committing")
            store.create_dir(f"{root}/{place}")
            store.move(batch.folder, f"{root}/{made.folder}")
            _publish(store, f"{root}/commits/{self.generation}/{self.write_id}@{done.part}-{done.attempt}-{k}.json", {"batches": [asdict(made)], "metrics": {"row_count": batch.rows, "upload_count": 1}})
        done.batches.append(made)
        times.rows += batch.rows
        times.uploads += 1
        times.enter("collecting")

    # on the driver

    def commit(self, messages: list[TaskDone | None]) -> None:
        store, root = _open(self.options.path)
        store.create_dir(root)  # a write without rows has made none
        before, old = _read_json(store, f"{root}/manifest.json"), read_manifest(self.options.path)
        if not self.overwrite and before:
            self.generation = before["generation"]  # an overwrite may have come between
        added, metrics = [], {}
        for done in sorted((m for m in messages if m), key=lambda m: m.part):
            if done.batches and not self.options.immediate_commit:
                self._place(store, root, done)
            added += [asdict(b) for b in done.batches]
            metrics = summed([metrics, done.metrics])
        store.create_dir(f"{root}/commits/{self.generation}")
        _publish(store, f"{root}/commits/{self.generation}/{self.write_id}.json", {"batches": added, "metrics": metrics})
        self._define(store, root, before)
        if self.overwrite:
            self._remove(store, root, old)
        self._sweep(store, root)

    def _place(self, store: fs.FileSystem, root: str, done: TaskDone) -> None:
        """Move a task's folder to its place; where another writer has come first, to a place of its own."""
        place = done.batches[0].folder.split("/")[0]
        taken = _exists(store, f"{root}/{place}")
        if taken:
            place = f"part{done.part}.{self.write_id}"
        store.move(f"{root}/.writing/{self.write_id}/{done.attempt}", f"{root}/{place}")
        for k, b in enumerate(done.batches if taken else ()):
            b.folder = f"{place}/batch{k}"
            _write(store, f"{root}/{b.folder}/copy.sql", load_script(self.options, self.columns, b.folder, b.files, b.rows).encode())

    def abort(self, messages: list[TaskDone | None]) -> None:
        self._sweep(*_open(self.options.path))

    def _sweep(self, store: fs.FileSystem, root: str) -> None:
        """Remove the attempts of this write, and their folder where no other write has any."""
        if _exists(store, f"{root}/.writing/{self.write_id}"):
            store.delete_dir(f"{root}/.writing/{self.write_id}")
        if _exists(store, f"{root}/.writing") and not store.get_file_info(fs.FileSelector(f"{root}/.writing")):
            store.delete_dir(f"{root}/.writing")


def load_script(options: SinkOptions, columns: Sequence[TargetColumn], folder: str, files: Sequence[str], rows: int) -> str:
    """The statement that loads a batch from its place."""
    place = f"{options.prefix or options.path}/{folder}"
    return scripts.load(options.table, columns, [f"{place}/{n}" for n in files], rows, options.compression.level is not None, options.on_server)


class _OpenBatch:
    """A batch's open files: one fresh stream for each column."""

    def __init__(self, store: fs.FileSystem, folder: str, columns: Sequence[TargetColumn], options: SinkOptions):
        self.store, self.folder, self.columns, self.options, self.rows = store, folder, columns, options, 0
        store.create_dir(folder)
        self.names = [scripts.file_name(i, c.name, options.compression.suffix) for i, c in enumerate(columns)]
        self.streams = [store.open_output_stream(f"{folder}/{n}", compression=None) for n in self.names]
        self.encoders = [backref.Encoder(options.backrefs) if c.kind in STRINGS and options.backrefs >= 0 else None for c in columns]

    def add(self, records: pa.RecordBatch) -> None:
        self.rows += records.num_rows
        for i, column in enumerate(self.columns):
            values = records.column(i)
            data = self.encoders[i].encode_array(_framable(values)) if self.encoders[i] else wire.encode(values, column)
            self.streams[i].write(self.options.compression.frame(data))

    def close(self, folder: str) -> list[str]:
        for s in self.streams:
            s.close()
        _write(self.store, f"{self.folder}/copy.sql", load_script(self.options, self.columns, folder, self.names, self.rows).encode())
        return self.names


def _framable(values: pa.Array) -> pa.Array:
    if pc.any(pc.match_substring(values.cast(pa.string()), "\x00")).as_py():
        raise ConversionError("a text with a zero byte can't be framed")
    return values


class ColumnFileReader(DataSourceReader):
    """Reads a dump back, a task for each batch."""

    def __init__(self, options: SinkOptions, schema: T.StructType):
        self.options, self.schema = options, schema
        self.manifest = read_manifest(options.path) or {"columns": [], "written": [], "batches": []}

    def partitions(self) -> list[Batch]:
        found = [Batch(**b) for b in self.manifest["batches"]]
        return found or [Batch("", 0, [], False, False)]

    def read(self, batch: Batch) -> Iterator[pa.RecordBatch]:
        if not batch.rows:
            return
        store, root = _open(self.options.path)
        kinds = {n: TargetColumn.parse(n, t) for n, t in self.manifest["columns"]}
        at = {n: i for i, n in enumerate(self.manifest["written"])}
        columns = []
        for f in self.schema:
            target = kinds[f.name]
            if f.name not in at:
                columns.append(pa.nulls(batch.rows, wire.arrow_type(target)))
                continue
            with store.open_input_stream(f"{root}/{batch.folder}/{batch.files[at[f.name]]}", compression=None) as s:
                data = s.read()
            data = unframed(data) if batch.lz4 else data
            if target.kind in STRINGS and batch.backrefs:
                columns.append(pa.array(backref.decode(data), pa.binary()).cast(pa.string()))
            else:
                columns.append(wire.decode(data, target))
        yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in self.schema])


class ColumnFiles(DataSource):
    """``spark.read`` and ``df.write`` with ``format("colsink")``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        manifest = read_manifest(SinkOptions.parse(self.options).path)
        if manifest is None:
            raise ValueError("there is no dump at this path")
        return stored_schema(TargetColumn.parse(n, t) for n, t in manifest["columns"])

    def reader(self, schema: T.StructType) -> ColumnFileReader:
        return ColumnFileReader(SinkOptions.parse(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> ColumnFileWriter:
        options = SinkOptions.parse(self.options)
        if overwrite and "dumpdir" in {k.lower() for k in self.options}:
            raise ValueError("dumpdir can't be overwritten; use path")
        before = read_manifest(options.path)
        if options.target:
            every = target_columns(options.target)
        elif before and (not overwrite or options.truncate):
            every = [TargetColumn.parse(n, t) for n, t in before["columns"]]
        else:
            every = table_columns(schema)
        kinds = {c.name: c for c in every}
        columns = []
        for f in schema:
            if f.name not in kinds:
                raise ConversionError(f"the target has no column {f.name}")
            columns.append(kinds[f.name])
        stored = stored_schema(columns)
        for f, s in zip(schema, stored):
            if f.dataType != s.dataType and not (isinstance(f.dataType, T.StringType) and isinstance(s.dataType, T.StringType)):
                raise ConversionError(f"column {f.name}: {f.dataType.simpleString()} must first be converted to {s.dataType.simpleString()}; write with write_dump")
        if before and not overwrite and [c.name for c in columns] != before["written"]:
            raise ConversionError("an append must have the columns of the dump, in its order")
        return ColumnFileWriter(options, columns, every, overwrite)


_REGISTERING = threading.Lock()


def register(spark: SparkSession) -> None:
    """Make the format known to a session, once."""
    with _REGISTERING:
        if not getattr(spark, "_colsink_registered", False):
            spark.dataSource.register(ColumnFiles)
            spark._colsink_registered = True


def write_dump(df: DataFrame, path: str, targets: Sequence[TargetColumn] | None = None, mode: str = "append", **options: str) -> None:
    """Convert ``df`` to its target and write it as column files.

    Without ``targets`` an existing dump's columns are the target (unless it is
    overwritten and not truncated), else those a new table would get. Conversion runs in
    generated code before the sink; a column that can't be converted raises here.
    """
    register(df.sparkSession)
    parsed = SinkOptions.parse({"path": path, **options})
    before = read_manifest(parsed.path)
    store, root = _open(parsed.path)
    if parsed.write_id and before and _exists(store, f"{root}/commits/{before['generation']}/{parsed.write_id}.json"):
        return  # this write has been committed
    if targets is None:
        keep = before and (mode != "overwrite" or parsed.truncate)
        targets = [TargetColumn.parse(n, t) for n, t in before["columns"]] if keep else table_columns(df.schema)
    made = plan(df, targets, parsed.null_on_overflow)
    writer = made.write.format(FORMAT).mode(mode).options(**options).option("target", target_text(targets))
    writer.save(path) if "dumpdir" not in {k.lower() for k in options} else writer.save()


def read_dump(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of a dump, as its last commit left it; of ``columns`` alone where given, whose files alone are read."""
    register(spark)
    reader = spark.read.format(FORMAT)
    if columns is not None:
        manifest = read_manifest(SinkOptions.parse({"path": path}).path)
        if manifest is None:
            raise ValueError("there is no dump at this path")
        kinds = {n: TargetColumn.parse(n, t) for n, t in manifest["columns"]}
        reader = reader.schema(stored_schema(kinds[c] for c in columns))
    return reader.load(path)


def dump_metrics(path: str) -> Mapping[str, int]:
    """Metrics summed over all tasks that wrote the dump."""
    return (read_manifest(path) or {"metrics": {}})["metrics"]
