"""Counts in sliding windows over the time of arrival.

A window always ends now: it holds what came in during the last ``size``. Each key keeps a ring
of pane counts, and a timer for each pane drops it when it leaves the window. What changes is
emitted, and a key whose window has become empty is emitted once more with a count of 0, so that
it vanishes from the table that the stream keeps.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..session import rocksdb_state
from .durations import millis
from .sinks import latest_rows, upsert_stream

# The processor travels whole, not by its name: Spark first runs it in a worker on the driver,
# which does not see the files that are sent to the tasks (--py-files).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ArrivalPanes(StatefulProcessor):
    """The panes of one key: pane number (time / slide) to count. At most size/slide + 1 of
    them are held, whatever the number of rows."""

    def __init__(self, key: str, width: int, slide: int):
        self.key, self.width, self.slide = key, width, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        pane, n = now // self.slide, sum(len(frame) for frame in rows)
        if self.panes.containsKey((pane,)):
            n += self.panes.getValue((pane,))[0]
        else:
            self.handle.registerTimer((pane + self.width) * self.slide)
        self.panes.updateValue((pane,), (n,))
        yield self._window(key, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._window(key, timerValues.getCurrentProcessingTimeInMs())

    def _window(self, key, now: int) -> pd.DataFrame:
        """The window that ends now, without the panes that have left it. Input and timers of
        one micro-batch see the same time, so they say the same."""
        last, total = now // self.slide, 0
        for (pane,), (n,) in list(self.panes.iterator()):
            if pane + self.width <= last:
                self.panes.removeKey((pane,))
            else:
                total += n
        return pd.DataFrame({self.key: [key[0]], "arrived": [pd.Timestamp(now, unit="ms")], "count": [total]})

    def close(self) -> None:
        pass


def arrival_counts(stream: DataFrame, key: str, size: str, slide: str) -> DataFrame:
    """(key, arrived, count): the changes of the counts of the last ``size``, which moves on by
    ``slide``; ``size`` is a multiple of it. ``arrived`` is when the count was taken. A count of
    0 says that the key's window is empty. Null keys are not counted."""
    width, rest = divmod(millis(size), millis(slide))
    if rest:
        raise ValueError(f"{size} is no multiple of {slide}")
    kind = stream.schema[key].dataType.simpleString()
    return (
        stream.select(key).where(F.col(key).isNotNull())
        .groupBy(key)
        .transformWithStateInPandas(
            ArrivalPanes(key, width, millis(slide)), f"`{key}` {kind}, arrived timestamp, count long", "Update", "ProcessingTime"
        )
    )


def start_arrivals(stream: DataFrame, key: str, size: str, slide: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start the counts into the change log at ``path``, a micro-batch every ``every`` (by
    default every ``slide``): panes leave the windows also while nothing arrives. The state is
    held in RocksDB, whatever the session's own setting."""
    counts = arrival_counts(stream, key, size, slide)
    with rocksdb_state(stream.sparkSession):
        return upsert_stream(counts, path, checkpoint, every or f"{millis(slide)} milliseconds")


def current_counts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The windows as they are now: keys whose window is empty are not there."""
    return latest_rows(spark, path, keys).where("count > 0")


def settle(query: StreamingQuery, wait: float = 0.2) -> None:
    """Wait until a running query has taken all input there is: a micro-batch without rows
    follows one that had some. (The query itself goes on for ever, for the timers.)"""
    seen = False
    while query.isActive:
        for progress in query.recentProgress:
            if progress["numInputRows"]:
                seen = True
            elif seen:
                return
        if not seen and len(query.recentProgress) > 1:
            return  # nothing to take
        time.sleep(wait)
    if query.exception() is not None:
        raise query.exception()
