"""Untuned linear regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..operators.features import with_features
from ..session import in_parallel, persisted


@dataclass
class Fitted:
    model: LinearRegressionModel
    coefficients: DataFrame
    predictions: DataFrame


def linreg_grid(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    reg: Sequence[float] = (0.01, 0.1, 0.5),
    elastic: Sequence[float] = (0.0, 0.5, 1.0),
    tolerance: float = 1e-6,
    parallelism: int = 8,
) -> DataFrame:
    """(reg_param, elastic_net_param, intercept, coefficients): one fit of the whole table
    per point of the grid."""
    data = with_features(df, numeric, categorical)
    estimator = LinearRegression(tol=tolerance)
    grid = (
        ParamGridBuilder()
        .addGrid(estimator.regParam, list(reg))
        .addGrid(estimator.elasticNetParam, list(elastic))
        .build()
    )
    with persisted(data.select(F.col(label).cast("double").alias("label"), "features")) as kept:
        models = in_parallel(
            df.sparkSession, lambda point: estimator.fit(kept, point), grid, parallelism
        )
    return df.sparkSession.createDataFrame(
        [
            (m.getRegParam(), m.getElasticNetParam(), float(m.intercept), [float(c) for c in m.coefficients])
            for m in models
        ],
        "reg_param double, elastic_net_param double, intercept double, coefficients array<double>",
    )


def linreg(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> Fitted:
    """Least squares over the whole table, solved from one pass over it.

    ``coefficients`` is one row (intercept, coefficients); ``predictions`` scores the
    same rows.
    """
    data = with_features(df, numeric, categorical).withColumn("label", F.col(label).cast("double"))
    model = LinearRegression().fit(data.select("label", "features"))
    coefficients = df.sparkSession.createDataFrame(
        [(float(model.intercept), [float(c) for c in model.coefficients])],
        "intercept double, coefficients array<double>",
    )
    return Fitted(model, coefficients, model.transform(data))
