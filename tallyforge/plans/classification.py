"""Untuned logistic regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..operators.features import with_features


def logreg(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    reg: float = 0.0,
    elastic: float = 0.0,
    tolerance: float = 1e-6,
) -> DataFrame:
    """``df`` with ``label``, ``prediction`` and the probability of label 1 in ``likelihood``,
    from a model of the whole table."""
    data = with_features(df, numeric, categorical).withColumn("label", F.col(label).cast("double"))
    model = LogisticRegression(
        regParam=reg, elasticNetParam=elastic, tol=tolerance, maxIter=200
    ).fit(data.select("label", "features"))
    return model.transform(data).withColumn("likelihood", vector_to_array("probability")[1])
