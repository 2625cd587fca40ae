"""Streams into column files: each micro-batch is one all-or-nothing append."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from colsink.plans.types import TargetColumn
from colsink.sources.column_files import write_dump


def stream_dump(stream: DataFrame, path: str, checkpoint: str, targets: Sequence[TargetColumn] | None = None, once: bool = False, **options: str) -> StreamingQuery:
    """Append a stream's micro-batches to a dump.

    A write is named by the checkpoint and the batch's number, so a batch that is repeated
    after a failure is appended once.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def append(rows: DataFrame, batch: int) -> None:
        write_dump(rows, path, targets, writeid=f"stream-{name}-{batch:012d}", **options)

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
