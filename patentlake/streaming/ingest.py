"""Incremental ingest: every file once, resumed from a checkpoint, applied in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentlake.sources.versions import VersionedTable


def ingest(source: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append what is new in a streaming source to a Parquet table; the sink's log makes it exactly once."""
    rows = transform(source) if transform else source
    rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def merge_stream(table: VersionedTable, changes: DataFrame, checkpoint: str, status: str = "source_status") -> int:
    """Merge what is new in a stream of changes, a version for each micro-batch; returns the last one.

    A change counts only if it isn't earlier by the table's order than what is stored for
    its key, so the result doesn't depend on how the feed is cut into batches. A batch that
    runs again, because the job ended between its version and the checkpoint, finds its
    number in the table's log and does nothing. Parts that ask for it are compacted at the
    end of a call; a call that ends before that leaves the table right, and the next does it.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        table.merge(rows, status, batch=(checkpoint, batch_id))

    changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return table.compact()


def latest_status(events: DataFrame, key: str, status: str, order: str) -> DataFrame:
    """Last status of each file; works on batches and, in update mode, on streams. State: a row for each file."""
    return events.groupBy(key).agg(F.max_by(status, order).alias("status"))


def status_table(table: VersionedTable, events: DataFrame, checkpoint: str, key: str, status: str, order: str) -> int:
    """Keep a table of the last status of each file, from a stream of events in any order; returns its last version.

    The stream's state is a row for each file, and only files whose row changed are merged.
    The table is keyed by `key`, ordered by `order`.
    """
    last = events.groupBy(key).agg(F.max_by(F.struct(status, order), order).alias("last")).select(key, f"last.{status}", f"last.{order}")

    def batch(rows: DataFrame, batch_id: int) -> None:
        table.merge(rows, status, batch=(checkpoint, batch_id))

    last.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return table.compact()
