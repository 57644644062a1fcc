"""The two named functions callers may use from SQL text.

Jobs never call these: the native forms in :mod:`tallyforge.functions.columns` are
faster. They exist so that SQL written against the names keeps working. Both are
registered as Arrow-batched functions, because a SQL-defined function is refused
inside ORDER BY.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession, functions as F

from .columns import EUROPEAN_COUNTRIES, KEPT_COUNTRIES, MONTHS


def register(spark: SparkSession) -> None:
    """Register ``getMonthNumber(string)`` and ``countryGrouping(string)``."""
    numbers = {name.lower(): i for i, name in enumerate(MONTHS)}
    groups = {c: "EUROPE" for c in EUROPEAN_COUNTRIES} | {c: c for c in KEPT_COUNTRIES}

    @F.pandas_udf("int")
    def month_index(names: pd.Series) -> pd.Series:
        found = names.str.lower().map(numbers)
        bad = found.isna() & names.notna()
        if bad.any():
            raise ValueError(f"not a month name: {names[bad].iloc[0]!r}")
        return found.astype("Int32")

    @F.pandas_udf("string")
    def grouping(countries: pd.Series) -> pd.Series:
        return countries.map(groups).fillna("OTHER")

    spark.udf.register("getMonthNumber", month_index)
    spark.udf.register("countryGrouping", grouping)
