"""Will a customer pay after the free trial?"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import at_least, country_group
from .trees import tree_vs_forest

# The models' inputs.
NUMERIC = ("rebill_period", "chapter_access_count", "seconds_watched")


def trial_rows(df: DataFrame) -> DataFrame:
    """Countries in groups, label 1 for customers with a payment."""
    return df.withColumns({"country": country_group("country"), "label": at_least("payments_made", 1)})


def pay_after_trial(df: DataFrame, key: str | None = None, **options) -> DataFrame:
    """(model, holdout_rows, accuracy, rules) for a decision tree and a random forest."""
    return tree_vs_forest(trial_rows(df), "label", NUMERIC, ["country"], key=key, **options)
