"""Names for ids in a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.joins import BROADCAST_ROWS, is_small, salted_join
from .sinks import append_batches


def enrich_stream(
    stream: DataFrame,
    dim: DataFrame,
    key: str,
    path: str,
    checkpoint: str,
    every: str | None = None,
    spread: Sequence[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> StreamingQuery:
    """Start a left join of a stream with a static table into a parquet table at ``path``.

    An unknown id gives null. Batches are joined one by one and written to folders of their
    own (``batch_id``), whatever the size of the table, so it may grow while the query runs: each
    batch measures it anew. A small table is broadcast; with a larger one the hot keys of each
    batch are found and split.
    """

    def join(batch: DataFrame) -> DataFrame:
        if is_small(dim, max_rows):
            return batch.join(F.broadcast(dim), key, "left")
        return salted_join(batch, dim, key, "left", spread)

    return append_batches(stream, path, checkpoint, every, join)
