"""k-means for a range of cluster numbers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame

from ..operators.features import with_features
from ..operators.metrics import silhouette
from ..session import in_parallel, persisted


def kmeans_sweep(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    ks: Iterable[int] = range(2, 9),
    seed: int = 42,
    parallelism: int = 8,
    features: str | None = None,
) -> DataFrame:
    """(k, sse, silhouette, sizes, centres), one row per number of clusters.

    ``features`` names a vector column to use instead of assembling one. The vectors are
    kept once for all fits, ``parallelism`` of which run at a time.
    """
    vectors = df.select(features) if features else with_features(df, numeric, categorical).select("features")
    column = features or "features"
    with persisted(vectors) as kept:

        def fit(k: int):
            model = KMeans(k=k, seed=seed, featuresCol=column).fit(kept)
            score = silhouette(model.transform(kept), column)
            centres = [[float(x) for x in c] for c in model.clusterCenters()]
            return k, model.summary.trainingCost, score, model.summary.clusterSizes, centres

        rows = in_parallel(df.sparkSession, fit, ks, parallelism)
    return df.sparkSession.createDataFrame(
        rows,
        "k int, sse double, silhouette double, sizes array<long>, centres array<array<double>>",
    )
