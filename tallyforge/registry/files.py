"""File sources: each query writes a table out in the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text
from ..plans import files as jobs
from ..session import scratch_path
from ..sources.tables import read_csv, read_delimited, read_table, stop_words
from .base import query

_STAMP = "yyyy-MM-dd HH:mm:ss"


def _log_rows(spark, sf):
    return read_table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("level"),
        F.date_format("o_orderdate", _STAMP).alias("datetime"),
    )


@query(
    "csv_header_strings",
    "SELECT o_orderpriority AS level, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS datetime, "
    "count(*) AS rows FROM orders GROUP BY ALL",
)
def csv_header_strings(spark, sf):
    path = scratch_path(spark, "csv_header")
    _log_rows(spark, sf).write.option("header", True).csv(path)
    return read_csv(spark, path).groupBy("level", "datetime").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "csv_month_counts",
    "SELECT o_orderpriority AS level, strftime(o_orderdate, '%B') AS month, count(*) AS total "
    "FROM orders GROUP BY ALL",
)
def csv_month_counts(spark, sf):
    path = scratch_path(spark, "csv_months")
    _log_rows(spark, sf).write.option("header", True).csv(path)
    return jobs.log_months(spark, path)


@query(
    "csv_infer",
    "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
    "FROM customer",
)
def csv_infer(spark, sf):
    path = scratch_path(spark, "csv_infer")
    read_table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path, infer=True)


@query("csv_glob", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_glob(spark, sf):
    path = scratch_path(spark, "csv_glob")
    read_table(spark, sf, "supplier").write.option("header", True).csv(path)
    return read_csv(
        spark, f"{path}/*.csv", "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    )


@query("csv_headerless", "SELECT user_id AS userId, event_id AS chapterId FROM events")
def csv_headerless(spark, sf):
    path = scratch_path(spark, "csv_headerless")
    read_table(spark, sf, "events").select(
        "user_id", "event_id", F.date_format("ts", _STAMP)
    ).write.csv(path)
    return read_delimited(spark, path, "userId long, chapterId long")


@query(
    "text_lines",
    "SELECT event_type AS level, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, count(*) AS rows "
    "FROM events GROUP BY ALL",
)
def text_lines(spark, sf):
    path = scratch_path(spark, "text_lines")
    read_table(spark, sf, "events").select(
        F.concat_ws(",", "event_type", F.date_format("ts", _STAMP))
    ).write.text(path)
    return jobs.log_lines(spark, path).groupBy("level", "date").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "top_words_stop_file",
    """
    WITH words AS (
        SELECT 'd' AS side,
               unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z ]', '', 'g')), ' ')) AS word
        FROM documents
        UNION ALL
        SELECT 'b', unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z ]', '', 'g')), ' '))
        FROM benchmark
    )
    SELECT word, count(*) AS count FROM words
    WHERE side = 'd' AND word <> '' AND word NOT IN (SELECT word FROM words WHERE side = 'b')
    GROUP BY word ORDER BY count DESC, word LIMIT 10
    """,
)
def top_words_stop_file(spark, sf):
    """Stop words: every word of the benchmark texts, kept in a file, one per line."""
    path = scratch_path(spark, "stop_words")
    text.word_counts(read_table(spark, sf, "benchmark"), "text").select("word").write.text(path)
    return text.top_words(read_table(spark, sf, "documents"), "text", stop_words(spark, path))
