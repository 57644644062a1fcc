"""Windowed counts. Every function takes a batch or a streaming table, so a stream's
result can be compared with the batch result over the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.columns import text_of
from ..session import checkpointed
from .durations import millis


def with_watermark(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if delay and df.isStreaming else df


def window_counts(
    df: DataFrame, ts: str, key: str, size: str, slide: str | None = None, watermark: str | None = None
) -> DataFrame:
    """(start, end, key, count) in tumbling or, with ``slide``, sliding windows.

    Each row enters size/slide windows, before it is counted. For many windows per row
    use :func:`pane_counts` and :func:`slide_panes` instead.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        with_watermark(df, ts, watermark)
        .groupBy(window.alias("window"), F.col(key))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("window.start", "window.end", key, "count")
    )


def pane_counts(df: DataFrame, ts: str, key: str, slide: str, watermark: str | None = None) -> DataFrame:
    """(pane, key, count): counts in tumbling panes as long as the slide.

    This is all the state a sliding count needs. It is smaller than the state of the
    sliding windows by the factor size/slide, and so is the shuffle.
    """
    return (
        window_counts(df, ts, key, slide, watermark=watermark)
        .withColumnRenamed("start", "pane")
        .drop("end")
    )


def slide_panes(panes: DataFrame, key: str, size: str, slide: str) -> DataFrame:
    """(start, end, key, count) in sliding windows, from pane counts (a batch table).

    ``size`` must be a multiple of ``slide``; each window is then a whole number of panes.
    """
    return (
        panes.groupBy(F.window("pane", size, slide).alias("window"), F.col(key))
        .agg(F.sum("count").alias("count"))
        .select("window.start", "window.end", key, "count")
    )


def slide_differences(panes: DataFrame, key: str, size: str, slide: str, per_range: int = 4096) -> DataFrame:
    """The same as :func:`slide_panes`, by difference events: a pane of n raises the count by n
    at the first window that holds it and lowers it by n behind the last.

    Two rows per pane are shuffled, whatever size/slide is, and the running sum of the events is
    the count. Time is cut into ranges of ``per_range`` slides, so that a key's events are spread
    over many tasks; each range begins with the sum of the ranges before it, which are few rows.
    A count holds until the key's next event, in a later range perhaps: the windows in between
    are made where the event is, after the shuffle.
    """
    step = millis(slide)
    width, rest = divmod(millis(size), step)
    if rest:
        raise ValueError(f"{size} is no multiple of {slide}")
    number = F.floor(F.unix_millis("pane") / F.lit(step)).cast("bigint")
    events = panes.select(
        F.col(key).alias("tf_key"), F.explode(F.array(
            F.struct((number - (width - 1)).alias("at"), F.col("count").alias("by")),
            F.struct((number + 1).alias("at"), (-F.col("count")).alias("by")),
        )).alias("e"),
    ).groupBy("tf_key", F.col("e.at").alias("at")).agg(F.sum("e.by").alias("by")).where("by <> 0")
    events = checkpointed(events.withColumn("range", F.floor(F.col("at") / F.lit(per_range)).cast("bigint")))
    whole = Window.partitionBy("tf_key").orderBy("range")
    ranges = (
        events.groupBy("tf_key", "range").agg(F.sum("by").alias("by"), F.min("at").alias("opens"))
        .select(
            F.col("tf_key").alias("same"), F.col("range").alias("part"), F.lead("opens").over(whole).alias("next_opens"),
            (F.sum("by").over(whole) - F.col("by")).alias("carry"),
        )
    )
    inside = Window.partitionBy("tf_key", "range").orderBy("at")
    levels = (
        events.join(ranges, F.col("tf_key").eqNullSafe(F.col("same")) & (F.col("range") == F.col("part")))
        .withColumn("count", F.col("carry") + F.sum("by").over(inside))
        .withColumn("until", F.coalesce(F.lead("at").over(inside), F.col("next_opens")))
        .where("count > 0")
    )
    starts = levels.select("tf_key", "count", F.explode(F.sequence("at", F.col("until") - 1)).alias("n"))
    return starts.select(
        F.timestamp_millis(F.col("n") * step).alias("start"), F.timestamp_millis((F.col("n") + width) * step).alias("end"), F.col("tf_key").alias(key), "count"
    )


def seconds_watched(
    df: DataFrame,
    ts: str = "timestamp",
    value: str = "value",
    size: str = "2 minutes",
    per_event: int = 5,
    watermark: str | None = None,
) -> DataFrame:
    """(window, course_name, seconds_watched): each event stands for ``per_event`` seconds."""
    return (
        with_watermark(df, ts, watermark)
        .groupBy(F.window(ts, size).alias("window"), text_of(value).alias("course_name"))
        .agg(F.sum(F.lit(per_event)).alias("seconds_watched"))
    )


def seconds_watched_sql(
    spark: SparkSession, view: str, size: str = "2 minutes", per_event: int = 5
) -> DataFrame:
    """The same as SQL text over a registered table or stream with value and timestamp."""
    return spark.sql(
        f"""
        WITH named AS (SELECT timestamp, CAST(value AS STRING) AS course_name FROM {view})
        SELECT window(timestamp, '{size}') AS window, course_name, sum({per_event}) AS seconds_watched
        FROM named
        GROUP BY window(timestamp, '{size}'), course_name
        """
    )


def rank_batch(counts: DataFrame, key: str) -> DataFrame:
    """Windows in time order, in each the most frequent key first (a batch table)."""
    return counts.orderBy("start", F.desc("count"), key)
