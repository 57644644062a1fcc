"""House prices: correlations, and a tuned regression in two forms."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import ratio
from ..operators.profile import corr_matrix, corr_target
from .tuning import Tuned, tune_linreg, tune_linreg_pipeline

# Columns left out from the start, columns left out for their weak
# correlation with the price, and the model's inputs.
NOT_FEATURES = ("id", "date", "view", "yr_renovated", "lat", "long")
WEAK_FEATURES = ("sqft_lot", "sqft_lot15", "yr_built", "sqft_living15")
NUMERIC = ("bedrooms", "bathrooms", "sqft_living", "sqft_above_percentage", "floors", "waterfront")
CATEGORICAL = ("condition", "grade", "zipcode")


def price_correlations(df: DataFrame) -> DataFrame:
    """Correlation of the price with every candidate column."""
    return corr_target(df.drop(*NOT_FEATURES), "price")


def feature_correlations(df: DataFrame) -> DataFrame:
    """Correlations among the columns that are kept."""
    return corr_matrix(df.drop(*NOT_FEATURES, *WEAK_FEATURES))


def with_share_above(df: DataFrame) -> DataFrame:
    return df.withColumn("sqft_above_percentage", ratio("sqft_above", "sqft_living"))


def price_model(df: DataFrame, key: str | None = None, **options) -> Tuned:
    return tune_linreg(with_share_above(df), "price", NUMERIC, CATEGORICAL, key=key, **options)


def price_pipeline(df: DataFrame, key: str | None = None, **options) -> Tuned:
    return tune_linreg_pipeline(with_share_above(df), "price", NUMERIC, CATEGORICAL, key=key, **options)
