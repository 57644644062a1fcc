"""Streaming queries: the events table is replayed as a stream into the shared folder, and
the table the stream left there is returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import streams as jobs
from ..session import scratch_path
from ..sources.streams import table_stream
from ..sources.tables import read_table, register_view
from ..streaming import windows as W
from ..streaming.arrival import current_counts, settle, start_arrivals
from ..streaming.enrich import enrich_stream
from ..streaming.sinks import append_stream, latest_rows, upsert_stream
from .base import query


def _naive(df, *cols):
    """Timestamps without a time zone, as in the given tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _upserted(spark, stream, name, keys):
    path = scratch_path(spark, name)
    upsert_stream(stream, path, f"{path}-checkpoint").awaitTermination()
    return latest_rows(spark, path, keys)


# Input taken by one micro-batch of a replay, so that a long history is worked off in
# steps, each of them a restart point.
_BATCH_INPUT = 256 << 30


def _events(spark, sf):
    return table_stream(spark, sf, "events", max_bytes=_BATCH_INPUT)


def _messages(spark, sf, *fields):
    """The events as messages: a binary value, a timestamp."""
    value = F.concat_ws(",", *(fields or ["event_type"]))
    return _events(spark, sf).select(
        F.encode(value, "utf-8").alias("value"), F.col("ts").alias("timestamp")
    )


_TUMBLING_SQL = """
    SELECT time_bucket(INTERVAL 2 MINUTE, ts) AS start,
           time_bucket(INTERVAL 2 MINUTE, ts) + INTERVAL 2 MINUTE AS "end",
           event_type AS course_name, CAST(sum(5) AS BIGINT) AS seconds_watched
    FROM events GROUP BY ALL
"""


def _flat(df):
    return df.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"),
        "course_name", "seconds_watched",
    )


@query("tumbling_seconds", _TUMBLING_SQL)
def tumbling_seconds(spark, sf):
    counts = _flat(jobs.course_seconds(_messages(spark, sf)))
    table = _upserted(spark, counts, "tumbling", ["start", "end", "course_name"])
    return _naive(table, "start", "end")


@query("tumbling_seconds_sql", _TUMBLING_SQL)
def tumbling_seconds_sql(spark, sf):
    register_view(_messages(spark, sf), "view_messages")
    counts = _flat(W.seconds_watched_sql(spark, "view_messages"))
    table = _upserted(spark, counts, "tumbling_sql", ["start", "end", "course_name"])
    return _naive(table, "start", "end")


def _sliding_sql(size_s, slide_s):
    return f"""
        WITH panes AS (
            SELECT time_bucket(INTERVAL {slide_s} SECOND, ts) AS pane, event_type, count(*) AS n
            FROM events GROUP BY ALL
        ),
        placed AS (
            SELECT pane - i * INTERVAL {slide_s} SECOND AS start, event_type, n
            FROM panes, range({size_s // slide_s}) r(i)
        )
        SELECT start, start + INTERVAL {size_s} SECOND AS "end", event_type,
               CAST(sum(n) AS BIGINT) AS count
        FROM placed GROUP BY start, event_type
    """


def _sliding(spark, panes, key, size, slide):
    table = _upserted(spark, panes, f"panes_{key}", ["pane", key])
    windows = W.slide_panes(table, key, size, slide).withColumnRenamed(key, "event_type")
    return _naive(windows, "start", "end")


@query("sliding_views", _sliding_sql(3600, 60))
def sliding_views(spark, sf):
    """60-minute windows every minute, in each the most frequent type first."""
    panes = jobs.course_view_panes(_messages(spark, sf), "1 minute")
    counts = _sliding(spark, panes, "course_name", "60 minutes", "1 minute")
    return W.rank_batch(counts, "event_type")


@query("level_window", _sliding_sql(60, 2))
def level_window(spark, sf):
    """1-minute windows every 2 seconds, over ``level,date`` lines."""
    panes = jobs.log_level_panes(_messages(spark, sf, "event_type", F.col("ts").cast("string")))
    return _sliding(spark, panes, "level", "1 minute", "2 seconds")


@query("sliding_direct", _sliding_sql(3600, 600))
def sliding_direct(spark, sf):
    """60-minute windows every 10 minutes, held as window state in the stream itself."""
    counts = jobs.course_views(_messages(spark, sf), "60 minutes", "10 minutes")
    table = _upserted(spark, counts, "sliding_direct", ["start", "end", "course_name"])
    return _naive(table.withColumnRenamed("course_name", "event_type"), "start", "end")


def _views(spark, sf):
    return W.pane_counts(_messages(spark, sf).select("timestamp", F.col("value").cast("string").alias("course_name")), "timestamp", "course_name", "1 minute")


@query("sliding_differences", _sliding_sql(3600, 60))
def sliding_differences(spark, sf):
    """60-minute windows every minute, from two difference events per pane."""
    panes = _upserted(spark, _views(spark, sf), "panes_difference", ["pane", "course_name"])
    windows = W.slide_differences(panes, "course_name", "60 minutes", "1 minute")
    return _naive(windows.withColumnRenamed("course_name", "event_type"), "start", "end")


@query("tumbling_compacted", _TUMBLING_SQL)
def tumbling_compacted(spark, sf):
    """The seconds watched, in a change log that is compacted as it grows."""
    path, keys = scratch_path(spark, "tumbling_compacted"), ["start", "end", "course_name"]
    events = table_stream(spark, sf, "events", max_files=1)
    messages = events.select(F.encode("event_type", "utf-8").alias("value"), F.col("ts").alias("timestamp"))
    upsert_stream(_flat(jobs.course_seconds(messages)), path, f"{path}-checkpoint", keys=keys).awaitTermination()
    return _naive(latest_rows(spark, path, keys), "start", "end")


@query("arrival_views", "SELECT event_type, count(*) AS count FROM events GROUP BY ALL")
def arrival_views(spark, sf):
    """Views that arrived within the last day: all of them, as the replay has just begun. A
    missing type is a key as well: types are marked by a sign in front, and it has none."""
    path = scratch_path(spark, "arrival")
    marked = F.coalesce(F.concat(F.lit("="), "event_type"), F.lit("")).alias("event_type")
    running = start_arrivals(_events(spark, sf).select(marked), "event_type", "24 hours", "1 minute", path, f"{path}-checkpoint", "1 second")
    try:
        settle(running)
    finally:
        running.stop()
    known = F.expr("CASE WHEN event_type <> '' THEN substring(event_type, 2) END").alias("event_type")
    return current_counts(spark, path, ["event_type"]).select(known, "count")


@query(
    "windowed_append",
    """
    WITH counted AS (
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start,
               time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end",
               event_type, count(*) AS count
        FROM events GROUP BY ALL
    )
    SELECT * FROM counted WHERE "end" <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    """,
)
def windowed_append(spark, sf):
    """Windows are written once, when the watermark has passed their end. The replay is one
    micro-batch: its files need not be in time order, and a row behind the watermark of an
    earlier batch would be left out."""
    counts = W.window_counts(
        table_stream(spark, sf, "events"), "ts", "event_type", "1 hour", watermark="10 minutes"
    )
    path = scratch_path(spark, "append")
    append_stream(counts, path, f"{path}-checkpoint").awaitTermination()
    return _naive(spark.read.parquet(path), "start", "end")


@query(
    "stream_enrich",
    "SELECT event_id, event_type, user_id AS c_custkey, c_name "
    "FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey",
)
def stream_enrich(spark, sf):
    """Names of the customers in credit; others are unknown ids."""
    names = read_table(spark, sf, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name")
    stream = _events(spark, sf).select(
        "event_id", "event_type", F.col("user_id").alias("c_custkey")
    )
    path = scratch_path(spark, "enrich")
    enrich_stream(stream, names, "c_custkey", path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path).select("event_id", "event_type", "c_custkey", "c_name")
