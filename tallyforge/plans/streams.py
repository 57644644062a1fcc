"""The stream jobs: from ``value`` and ``timestamp`` to windowed counts.

Each takes the output of :func:`tallyforge.sources.streams.event_stream` (or a batch table
with these columns) and leaves starting the query to the caller. Windows go by the
message's timestamp. Give a ``watermark`` for a query that runs on and on: without one
all windows are kept, and late rows are never left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import field, text_of
from ..streaming.windows import pane_counts, seconds_watched, window_counts


def log_levels(
    stream: DataFrame, size: str = "1 minute", slide: str = "2 seconds", watermark: str | None = None
) -> DataFrame:
    """(start, end, level, count) of ``level,date`` lines in sliding windows."""
    lines = stream.select(F.col("timestamp"), field(text_of("value"), 1).alias("level"))
    return window_counts(lines, "timestamp", "level", size, slide, watermark)


def log_level_panes(stream: DataFrame, slide: str = "2 seconds", watermark: str | None = None) -> DataFrame:
    """(pane, level, count): what :func:`log_levels` needs of each slide."""
    lines = stream.select(F.col("timestamp"), field(text_of("value"), 1).alias("level"))
    return pane_counts(lines, "timestamp", "level", slide, watermark)


def course_views(
    stream: DataFrame, size: str = "60 minutes", slide: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    """(start, end, course_name, count) in sliding windows."""
    views = stream.select(F.col("timestamp"), text_of("value").alias("course_name"))
    return window_counts(views, "timestamp", "course_name", size, slide, watermark)


def course_view_panes(stream: DataFrame, slide: str = "1 minute", watermark: str | None = None) -> DataFrame:
    """(pane, course_name, count): what :func:`course_views` needs of each slide."""
    views = stream.select(F.col("timestamp"), text_of("value").alias("course_name"))
    return pane_counts(views, "timestamp", "course_name", slide, watermark)


def course_seconds(stream: DataFrame, watermark: str | None = None) -> DataFrame:
    """(window, course_name, seconds_watched): 5 seconds per message, in 2-minute windows."""
    return seconds_watched(stream, "timestamp", "value", "2 minutes", 5, watermark)
