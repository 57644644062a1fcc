"""Jobs from files to a report, in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import field, scaled
from ..operators.crosstab import month_counts, month_pivot, pivot_stats
from ..operators.popularity import popularity
from ..operators.profile import key_sizes, partition_counts
from ..operators.text import top_words
from ..sources.tables import read_csv, read_delimited, read_lines, stop_words


def log_months(spark: SparkSession, path: str) -> DataFrame:
    """Log lines per level and month (CSV with header level, datetime)."""
    return month_counts(read_csv(spark, path), "level", "datetime")


def log_month_table(spark: SparkSession, path: str) -> DataFrame:
    """The same with a column per month."""
    return month_pivot(read_csv(spark, path), "level", "datetime")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(level, date) of ``level,date`` text lines."""
    return read_lines(spark, path).select(
        field("value", 1).alias("level"), field("value", 2).alias("date")
    )


def log_level_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(level, count) of ``level,date`` text lines."""
    return key_sizes(log_lines(spark, path), "level")


def log_partitions(spark: SparkSession, path: str) -> DataFrame:
    """(step, partitions, rows) before and after the narrow and the wide step of
    :func:`log_level_sizes`."""
    pairs = log_lines(spark, path)
    return partition_counts(
        {"lines": read_lines(spark, path), "narrow": pairs, "wide": key_sizes(pairs, "level")}
    )


def exam_results(spark: SparkSession, path: str) -> DataFrame:
    """Mean and deviation of the score per subject and year (CSV with header)."""
    return pivot_stats(read_csv(spark, path), "subject", "year", "score")


def frequent_words(spark: SparkSession, path: str, stop_path: str | None = None, n: int = 10) -> DataFrame:
    """Most frequent words of text files, without those of a stop-word file."""
    stop = stop_words(spark, stop_path) if stop_path else None
    return top_words(read_lines(spark, path), "value", stop, n)


def course_popularity(spark: SparkSession, views: str, chapters: str, titles: str) -> DataFrame:
    """Course scores from headerless files of views, chapters and titles."""
    return popularity(
        read_delimited(spark, views, "userId int, chapterId int"),
        read_delimited(spark, chapters, "chapterId int, courseId int"),
        read_delimited(spark, titles, "courseId int, title string"),
    )


def course_ratings(spark: SparkSession, path: str) -> DataFrame:
    """(userId, courseId, rating): watched share in percent (CSV with header)."""
    df = read_csv(spark, path, infer=True)
    return df.select("userId", "courseId", scaled("proportionWatched", 100).alias("rating"))
