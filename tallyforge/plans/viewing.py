"""Customers' viewing: how much will they watch next month, and will they stop?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import not_above, zero_nulls
from .tuning import Tuned, TunedClassifier, tune_linreg, tune_logreg

# The model's inputs and the parameter grid.
NUMERIC = ("firstSub", "age", "all_time_views", "last_month_views")
CATEGORICAL = ("payment_method_type", "country", "rebill_period_in_months")
REG_PARAMS = (0.01, 0.1, 0.5, 0.7, 0.9)
ELASTIC_NET_PARAMS = (0.0, 0.5, 1.0)

_COUNTS = ("firstSub", "all_time_views", "last_month_views")


def _active(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_cancelled")).drop("is_cancelled", "observation_date")


def prepare_views(df: DataFrame) -> DataFrame:
    """Customers who have not cancelled; a missing count means none."""
    return zero_nulls(_active(df), (*_COUNTS, "next_month_views"))


def prepare_churn(df: DataFrame) -> DataFrame:
    """As above, with ``next_month_views`` turned into 1 = watches nothing next month."""
    return zero_nulls(_active(df), _COUNTS).withColumn("next_month_views", not_above("next_month_views"))


def next_month_views(df: DataFrame, key: str | None = None, **options) -> Tuned:
    grid = dict(reg=REG_PARAMS, elastic=ELASTIC_NET_PARAMS, train_ratio=0.9, holdout=0.1)
    return tune_linreg(
        prepare_views(df), "next_month_views", NUMERIC, CATEGORICAL, key=key, **(grid | options)
    )


def stop_watching(df: DataFrame, key: str | None = None, **options) -> TunedClassifier:
    grid = dict(reg=REG_PARAMS, elastic=ELASTIC_NET_PARAMS, train_ratio=0.9, holdout=0.1)
    return tune_logreg(
        prepare_churn(df), "next_month_views", NUMERIC, CATEGORICAL, key=key, **(grid | options)
    )
