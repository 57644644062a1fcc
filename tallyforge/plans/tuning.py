"""Grid search with one training/validation split, and the report of the chosen model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, Row, functions as F

from ..operators.features import feature_stages, with_features
from ..operators.metrics import accuracy, class_likelihoods, class_rates, confusion, regression_metrics
from ..operators.split import marked_split, with_mark
from ..session import persisted


#: A grid search passes over its rows some hundred times, in tasks of so many rows.
ROWS_PER_TASK = 250_000


@dataclass
class Tuned:
    """A chosen model, its one-row report, the grid it was chosen from and its
    predictions for the hold-out rows."""

    model: Model
    report: DataFrame
    grid: DataFrame
    predictions: DataFrame


def _search(
    estimator: LinearRegression | LogisticRegression,
    evaluator: Evaluator,
    reg: Sequence[float],
    elastic: Sequence[float],
    train_ratio: float,
    seed: int,
    parallelism: int,
) -> TrainValidationSplit:
    grid = (
        ParamGridBuilder()
        .addGrid(estimator.regParam, list(reg))
        .addGrid(estimator.elasticNetParam, list(elastic))
        .build()
    )
    return TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        trainRatio=train_ratio,
        parallelism=parallelism,
        seed=seed,
    )


def _grid_table(like: DataFrame, search: TrainValidationSplit, fitted) -> DataFrame:
    points = [
        (*(float(v) for _, v in sorted(p.items(), key=lambda kv: kv[0].name, reverse=True)), float(m))
        for p, m in zip(search.getEstimatorParamMaps(), fitted.validationMetrics)
    ]
    return like.sparkSession.createDataFrame(
        points, "reg_param double, elastic_net_param double, metric double"
    )


def _report_table(like: DataFrame, best, metrics: Row, names: Sequence[str]) -> DataFrame:
    """One row: the chosen linear model, its metrics, the chosen parameters."""
    values = (
        float(best.intercept),
        [float(c) for c in best.coefficients],
        *[metrics[name] for name in names],
        float(best.getRegParam()),
        float(best.getElasticNetParam()),
    )
    columns = ", ".join(f"{name} double" for name in names)
    return like.sparkSession.createDataFrame(
        [values],
        f"intercept double, coefficients array<double>, {columns}, "
        "reg_param double, elastic_net_param double",
    )


def _regression_report(best, train: DataFrame, held: DataFrame) -> DataFrame:
    """rmse and r2 of both parts, in one pass over their union."""
    scored = best.transform(train).select("label", "prediction", F.lit("train").alias("part")).unionAll(
        best.transform(held).select("label", "prediction", F.lit("holdout").alias("part"))
    )
    parts = regression_metrics(scored, by=["part"])
    names = [f"{m}_{part}" for part in ("train", "holdout") for m in ("rmse", "r2")]
    metrics = parts.agg(
        *[F.max(F.when(F.col("part") == n.split("_")[1], F.col(n.split("_")[0]))).alias(n) for n in names]
    ).first()
    return _report_table(train, best, metrics, names)


def tune_linreg(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    reg: Sequence[float] = (0.01, 0.1, 0.5),
    elastic: Sequence[float] = (0.0, 0.5, 1.0),
    train_ratio: float = 0.8,
    holdout: float = 0.2,
    key: str | None = None,
    seed: int = 42,
    parallelism: int = 8,
) -> Tuned:
    """Linear regression chosen by r2 on the validation part.

    Categories are numbered over the whole table, so none is unknown in the hold-out.
    """
    data = with_features(with_mark(df, key, holdout, seed), numeric, categorical)
    columns = [F.col(label).cast("double").alias("label"), "features"]
    with persisted(data.select(*columns, "_held"), ROWS_PER_TASK) as kept:
        train, held = marked_split(kept, holdout, seed)
        search = _search(
            LinearRegression(), RegressionEvaluator(metricName="r2"),
            reg, elastic, train_ratio, seed, parallelism,
        )
        fitted = search.fit(train)
        best = fitted.bestModel
        report = _regression_report(best, train, held)
    _, held = marked_split(data.withColumn("label", columns[0]), holdout, seed)
    return Tuned(best, report, _grid_table(df, search, fitted), best.transform(held))


def tune_linreg_pipeline(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    reg: Sequence[float] = (0.01, 0.1, 0.5),
    elastic: Sequence[float] = (0.0, 0.5, 1.0),
    train_ratio: float = 0.8,
    holdout: float = 0.2,
    key: str | None = None,
    seed: int = 42,
    parallelism: int = 8,
) -> Tuned:
    """As :func:`tune_linreg`, as one pipeline fitted on the training part alone.

    A category first met in the hold-out is given an index of its own.
    """
    label_column = F.col(label).cast("double").alias("label")
    inputs = [c for c in dict.fromkeys([*numeric, *categorical]) if c != "label"]
    data = with_mark(df, key, holdout, seed).withColumn("label", label_column)
    search = _search(
        LinearRegression(), RegressionEvaluator(metricName="r2"),
        reg, elastic, train_ratio, seed, parallelism,
    )
    stages: list[Estimator] = feature_stages(numeric, categorical, handle_invalid="keep")
    with persisted(data.select("label", *inputs, "_held"), ROWS_PER_TASK) as kept:
        train, held = marked_split(kept, holdout, seed)
        fitted = Pipeline(stages=[*stages, search]).fit(train)
        *steps, tuned = fitted.stages
        best = tuned.bestModel

        def encoded(part: DataFrame) -> DataFrame:
            for step in steps:
                part = step.transform(part)
            return part.select("label", "features")

        report = _regression_report(best, encoded(train), encoded(held))
    _, held = marked_split(data, holdout, seed)
    return Tuned(fitted, report, _grid_table(df, search, tuned), fitted.transform(held))


_RATES = ("recall_pos", "recall_neg", "likelihood_pos", "likelihood_neg")


@dataclass
class TunedClassifier(Tuned):
    rates: DataFrame
    confusion: DataFrame


def tune_logreg(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    reg: Sequence[float] = (0.01, 0.1, 0.5, 0.7, 0.9),
    elastic: Sequence[float] = (0.0, 0.5, 1.0),
    train_ratio: float = 0.9,
    holdout: float = 0.1,
    key: str | None = None,
    seed: int = 42,
    parallelism: int = 8,
    metric: str = "areaUnderROC",
) -> TunedClassifier:
    """Logistic regression chosen by ``metric``: areaUnderROC, areaUnderPR, or r2 of the
    0/1 predictions."""
    evaluator: Evaluator = (
        RegressionEvaluator(metricName="r2")
        if metric == "r2"
        else BinaryClassificationEvaluator(metricName=metric)
    )
    data = with_features(with_mark(df, key, holdout, seed), numeric, categorical)
    columns = [F.col(label).cast("double").alias("label"), "features"]
    with persisted(data.select(*columns, "_held"), ROWS_PER_TASK) as kept:
        train, held = marked_split(kept, holdout, seed)
        search = _search(
            LogisticRegression(), evaluator, reg, elastic, train_ratio, seed, parallelism
        )
        fitted = search.fit(train)
        best = fitted.bestModel
        trained = accuracy(best.transform(train)).first()
        metrics = class_likelihoods(best.transform(held)).select(
            F.lit(trained["accuracy"]).alias("accuracy_train"),
            F.col("accuracy").alias("accuracy_holdout"),
            *_RATES,
        ).first()
        report = _report_table(df, best, metrics, ["accuracy_train", "accuracy_holdout", *_RATES])
    _, held = marked_split(data.withColumn("label", columns[0]), holdout, seed)
    predictions = best.transform(held)
    return TunedClassifier(
        best, report, _grid_table(df, search, fitted), predictions,
        class_rates(predictions), confusion(predictions),
    )
