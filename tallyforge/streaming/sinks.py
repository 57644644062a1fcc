"""Running a stream into a table in the shared folder.

``upsert_stream`` is for update mode: a micro-batch holds the keys it changed, with
their new values. Each micro-batch becomes one folder of a change log, and the current
table is the last version of each key. Writing a batch again replaces its own folder,
so a restart after a failure leaves the result as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from .compaction import BATCH, compact, read_log



def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    order: Callable[[DataFrame], DataFrame] | None = None,
    keys: Sequence[str] | None = None,
) -> StreamingQuery:
    """Start an update-mode query into a change log at ``path``.

    Without ``every`` it takes all input there is and stops; with it (say ``'2
    seconds'``) it runs until stopped. ``order`` sorts each micro-batch before it is
    written. With ``keys`` the log is compacted as it grows, so that reading it costs as much
    as the table, however long the query has run.
    """

    def compacted(batch_id: int) -> None:
        if keys:
            compact(stream.sparkSession, path, keys, before=batch_id)

    return _batches(stream, "update", path, checkpoint, every, order, compacted)


def append_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start an append-mode query that changes each micro-batch as a batch table."""
    return _batches(stream, "append", path, checkpoint, every, transform)


def _batches(stream, mode, path, checkpoint, every, transform, before=None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        if before:
            before(batch_id)
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return _trigger(writer, every).start()


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current table of a change log: for each key the row of its last micro-batch. A log that is
    compacted (:mod:`tallyforge.streaming.compaction`) is read by its runs and young batches."""
    log = read_log(spark, path)
    values = [c for c in log.columns if c not in keys and c != BATCH]
    return log.groupBy(*keys).agg(*[F.max_by(v, BATCH).alias(v) for v in values])


def append_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start an append-mode query into a parquet table (each row once, exactly)."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()
