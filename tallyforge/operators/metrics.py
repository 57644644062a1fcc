"""Quality of predictions. Each function is one aggregate over a table of predictions,
whichever model they come from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, functions as F


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """(rmse, r2), for each group of ``by`` if given."""
    y, squared = F.col(label).cast("double"), F.pow(F.col(prediction) - F.col(label), 2)
    return (
        df.groupBy(*by)
        .agg(
            F.sqrt(F.avg(squared)).alias("rmse"),
            F.avg(squared).alias("_error"),
            F.var_pop(y).alias("_spread"),
        )
        .select(*by, "rmse", (1 - F.try_divide("_error", "_spread")).alias("r2"))
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """(rows, accuracy), for each group of ``by`` if given."""
    hit = F.col(label).cast("double") == F.col(prediction).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("accuracy"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def _outcomes(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label) > 0, F.col(prediction) > 0
    return df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(y & ~p).alias("fn"),
    )


def class_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, tpr, fpr) of a 0/1 classifier: one row per label, taken as the positive one."""
    tpr1 = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    tpr0 = F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    rows = F.array(
        F.struct(F.lit(0).alias("label"), tpr0.alias("tpr"), (1 - tpr1).alias("fpr")),
        F.struct(F.lit(1).alias("label"), tpr1.alias("tpr"), (1 - tpr0).alias("fpr")),
    )
    return _outcomes(df, label, prediction).select(F.inline(rows))


def class_likelihoods(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row for a 0/1 classifier.

    ``recall_pos`` / ``recall_neg`` are the true rates of label 1 and 0.
    ``likelihood_pos`` / ``likelihood_neg`` weigh the true against the false rate of the
    same label: tpr / (tpr + fpr). (Weighing against the *other* label's false rate would
    give the recall again, since for two labels that rate is 1 - tpr.)
    """
    tpr1 = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    tpr0 = F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    right = F.col("tp") + F.col("tn")
    return _outcomes(df, label, prediction).select(
        F.try_divide(right, right + F.col("fp") + F.col("fn")).alias("accuracy"),
        tpr1.alias("recall_pos"),
        tpr0.alias("recall_neg"),
        F.try_divide(tpr1, tpr1 + 1 - tpr0).alias("likelihood_pos"),
        F.try_divide(tpr0, tpr0 + 1 - tpr1).alias("likelihood_neg"),
    )


def silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance; cost linear in the rows."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(df)
