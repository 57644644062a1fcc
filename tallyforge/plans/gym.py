"""Gym competition: repetitions by body measures, and groups of competitors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .clusters import kmeans_sweep
from .regression import Fitted, linreg


def reps_model(df: DataFrame) -> Fitted:
    return linreg(df, "NoOfReps", ["Age", "Height", "Weight"], ["Gender"])


def competitor_clusters(df: DataFrame, **options) -> DataFrame:
    return kmeans_sweep(df, ["Age", "Height", "Weight", "NoOfReps"], ["Gender"], **options)
