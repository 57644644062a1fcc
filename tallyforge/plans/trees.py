"""Decision tree and random forest on the same split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import DataFrame, functions as F

from ..operators.features import with_features
from ..operators.metrics import accuracy
from ..operators.split import marked_split, with_mark
from ..session import persisted


def tree_vs_forest(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    depth: int = 5,
    trees: int = 20,
    bins: int = 32,
    holdout: float = 0.2,
    key: str | None = None,
    seed: int = 42,
    models: Sequence[str] = ("tree", "forest"),
    bootstrap: bool = True,
) -> DataFrame:
    """(model, holdout_rows, accuracy, rules), one row per model.

    Categories enter as indices with their metadata, so trees split them as sets of
    values; ``bins`` must reach the largest number of categories. Without ``bootstrap`` each tree of the forest is grown on all rows.
    """
    data = with_features(with_mark(df, key, holdout, seed), numeric, categorical, encode=False)
    columns = [F.col(label).cast("double").alias("label"), "features", "_held"]
    makers = {
        "tree": DecisionTreeClassifier(maxDepth=depth, maxBins=bins, seed=seed),
        "forest": RandomForestClassifier(maxDepth=depth, numTrees=trees, maxBins=bins, seed=seed, bootstrap=bootstrap),
    }
    rows = []
    with persisted(data.select(*columns)) as kept:
        train, held = marked_split(kept, holdout, seed)
        for name in models:
            model = makers[name].fit(train)
            result = accuracy(model.transform(held)).first()
            rows.append((name, result["rows"], result["accuracy"], model.toDebugString))
    return df.sparkSession.createDataFrame(
        rows, "model string, holdout_rows long, accuracy double, rules string"
    )
