"""Engagement scores: how much of each course did each user see."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import ENGAGEMENT_BUCKETS, bucket_score, percentage
from .joins import lookup_join


def chapters_per_course(chapters: DataFrame) -> DataFrame:
    """(courseId, total)."""
    return chapters.groupBy("courseId").agg(F.count(F.lit(1)).alias("total"))


def watched_per_user(views: DataFrame, chapters: DataFrame) -> DataFrame:
    """(userId, courseId, watched): distinct chapters a user saw of a course.

    Repeated views are removed before the join, partly before the shuffle already, so a
    chapter viewed over and over is no hot key; a chapter seen by very many users is
    split by user.
    """
    seen = views.select("userId", "chapterId").distinct()
    placed = lookup_join(
        seen, chapters.select("chapterId", "courseId"), "chapterId", spread=["userId"], sketch=views
    )
    return placed.groupBy("userId", "courseId").agg(F.count(F.lit(1)).alias("watched"))


def course_shares(views: DataFrame, chapters: DataFrame) -> DataFrame:
    """(courseId, watched, users, total): how many users saw so many chapters of a course.

    The users are counted before anything is joined to them. There is at most one row
    per chapter left then, however popular a course is.
    """
    histogram = (
        watched_per_user(views, chapters)
        .groupBy("courseId", "watched")
        .agg(F.count(F.lit(1)).alias("users"))
    )
    return histogram.join(chapters_per_course(chapters), "courseId")


def popularity(
    views: DataFrame,
    chapters: DataFrame,
    titles: DataFrame,
    buckets: Sequence[tuple[float, int]] = ENGAGEMENT_BUCKETS,
) -> DataFrame:
    """(title, score), best first.

    ``views`` has userId, chapterId; ``chapters`` chapterId, courseId; ``titles``
    courseId, title. Each user adds the score of the share of chapters they saw. Courses
    without views or without a title are left out.
    """
    score = bucket_score(percentage("watched", "total"), buckets)
    scores = (
        course_shares(views, chapters)
        .groupBy("courseId")
        .agg(F.sum(score * F.col("users")).alias("score"))
    )
    return scores.join(titles, "courseId").select("title", "score").orderBy(F.desc("score"), "title")
