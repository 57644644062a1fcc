"""Profiles of a table: keys, partitions, correlations, summary statistics."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce
from itertools import combinations, combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from ..session import checkpointed
from .moments import moments


def key_sizes(df: DataFrame, key: str) -> DataFrame:
    """(key, count): rows per key. Counted map-side first; groups are never gathered."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def key_count(df: DataFrame, key: str) -> DataFrame:
    """One row with the number of different keys, null included."""
    return df.select(key).distinct().agg(F.count(F.lit(1)).alias("keys"))


def integer_key_count(df: DataFrame, key: str) -> DataFrame:
    """The same as :func:`key_count` for a column of integers, with one bit per key shuffled
    instead of one row where keys lie close together: each task marks its keys in bitmaps of
    32,768 neighbouring values, which are merged by bucket. However often a key occurs, a task
    sends its bucket once."""
    own = F.col(key).cast("bigint")
    marks = (
        df.select(own.alias("k")).where(F.col("k").isNotNull())
        .groupBy(F.bitmap_bucket_number("k").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"))
    )
    counted = marks.select(F.bitmap_count("bits").alias("n")).union(df.where(own.isNull()).select(F.lit(1).cast("bigint")).limit(1))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("keys"))


def partition_profile(df: DataFrame, key: str) -> DataFrame:
    """(partition, key, rows) for the partitions ``df`` has where it is called."""
    return df.groupBy(F.spark_partition_id().alias("partition"), key).agg(
        F.count(F.lit(1)).alias("rows")
    )


def partition_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """(step, partitions, rows) of named stages of a job; partitions without rows do not
    count. The wide step of a job has as many as its shuffle left."""
    counted = [
        df.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        .select(F.lit(step).alias("step"), "partitions", "rows")
        for step, df in steps.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _pair_correlations(
    df: DataFrame, pairs: list[tuple[str, str]]
) -> dict[tuple[str, str], float | None]:
    """Pearson correlation of each pair over the rows where both are present; None if one of
    the two is constant there. NaN values give NaN.

    One scan serves all pairs. Spark's covariance and deviations merge centred moments, so
    values far from zero lose no accuracy.
    """
    found = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        spread = F.stddev_samp(F.when(both, x)) * F.stddev_samp(F.when(both, y))
        found.append(F.try_divide(F.covar_samp(x, y), spread).alias(f"pair{i}"))
    got = df.agg(*found).first() if pairs else []
    return dict(zip(pairs, got))


def corr_target(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """(col1, col2, corr) of the target with every numeric column."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    found = _pair_correlations(df, [(target, c) for c in cols])
    return df.sparkSession.createDataFrame(
        [(a, b, r) for (a, b), r in found.items()], "col1 string, col2 string, corr double"
    )


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(col1, col2, corr) for all ordered pairs of numeric columns."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    found = _pair_correlations(df, list(combinations_with_replacement(cols, 2)))
    rows = [(a, b, r) for (a, b), r in found.items()]
    rows += [(b, a, found[(a, b)]) for a, b in combinations(cols, 2)]
    return df.sparkSession.createDataFrame(rows, "col1 string, col2 string, corr double")


def corr_wide(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The same as :func:`corr_matrix` for hundreds of columns: matrix products over blocks of
    rows instead of an expression per pair. NaN counts as missing here."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    found = moments(df, cols) if cols else {}
    table = found[None].correlations() if found else np.full((len(cols), len(cols)), np.nan)
    rows = [(a, b, None if np.isnan(r) else float(r)) for a, line in zip(cols, table) for b, r in zip(cols, line)]
    return df.sparkSession.createDataFrame(rows, "col1 string, col2 string, corr double")


def summary_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, stddev, min, max) of numeric columns, from one scan."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(cols)
        ]
    )
    return one_row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))


def quantiles(df: DataFrame, cols: Sequence[str] | None = None, at: Sequence[float] = (0.25, 0.5, 0.75), k: int = 200) -> DataFrame:
    """(column, quantile, value): exact quantiles of numeric columns, as doubles; the value is the
    smallest one with at least that share of the values at or below it. Nulls do not count, NaN
    is the largest value, and a column without values gives null.

    One pass builds a mergeable sketch (KLL, a few kilobytes) of each column, which says between
    which two values each quantile lies, by rank and with room for its error. The second pass
    counts what is below each bracket and, by value, what is inside, about 4/k of the rows
    whatever their number. Should a bracket miss its quantile, which the counts show, that
    column's values are counted whole.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    for q in at:
        if not 0 <= q <= 1:
            raise ValueError(f"quantile {q} is not between 0 and 1")
    schema = "column string, quantile double, value double"
    if not cols or not at:
        return df.sparkSession.createDataFrame([], schema)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    plain = lambda i: F.when(~F.isnan(f"c{i}"), F.col(f"c{i}"))
    sketched = values.agg(*[x for i in range(len(cols)) for x in (
        F.kll_sketch_agg_double(plain(i), F.lit(k)).alias(f"s{i}"), F.count(f"c{i}").alias(f"n{i}"), F.count(plain(i)).alias(f"m{i}")
    )])
    slack = 4 / k  # the sketch's rank error is below 1.7 / k with a probability of 99 %

    sketched = checkpointed(sketched)  # one row; ranks must be plain numbers
    counts = sketched.select(*[c for i in range(len(cols)) for c in (f"n{i}", f"m{i}")]).first()

    def bracket(i: int, j: int) -> list[Column]:
        """Two values of the sketch between which the quantile must be, null for an open end."""
        n, m = counts[f"n{i}"], counts[f"m{i}"]
        rank = at[j] * n / m if m else 2.0  # above 1: among the NaN values
        edge = lambda r: F.kll_sketch_get_quantile_double(f"s{i}", F.lit(float(r)))
        low = edge(rank - slack) if 2 * slack < rank <= 1 else F.lit(None).cast("double")
        high = edge(rank + slack) if rank < 1 - 2 * slack else F.lit(None).cast("double")
        return [low.alias(f"l{i}_{j}"), high.alias(f"h{i}_{j}")]

    pairs = [(i, j) for i in range(len(cols)) for j in range(len(at)) if counts[f"n{i}"]]
    got = sketched.select(F.lit(1).alias("one"), *[x for i, j in pairs for x in bracket(i, j)]).first()
    asked = [(i, j, at[j], counts[f"n{i}"], got[f"l{i}_{j}"], got[f"h{i}_{j}"]) for i, j in pairs]
    found = _exact(values, asked)
    missed = [(i, j, q, n, None, None) for i, j, q, n, *_ in asked if (i, j) not in found]
    found |= _exact(values, missed)
    rows = [(c, float(q), found.get((i, j))) for i, c in enumerate(cols) for j, q in enumerate(at)]
    return df.sparkSession.createDataFrame(rows, schema)


def _exact(values: DataFrame, asked: list[tuple]) -> dict[tuple[int, int], float]:
    """The wanted quantiles that lie in their brackets (low, high), from one pass: for each the
    rows below it, and a table of the different values inside with their counts."""
    if not asked:
        return {}
    spark = values.sparkSession
    below = values.agg(*[F.count(F.when(F.col(f"c{i}") < F.lit(low), 1)) if low is not None else F.lit(0).cast("bigint") for i, _, _, _, low, _ in asked]).first()
    marks = []
    for number, (i, _, _, _, low, high) in enumerate(asked):
        own = F.col(f"c{i}")
        fits = own.isNotNull()
        fits = fits if low is None else fits & (own >= F.lit(low))
        fits = fits if high is None else fits & (own <= F.lit(high))
        marks.append(F.when(fits, F.struct(F.lit(number).alias("number"), own.alias("value"))))
    inside = values.select(F.explode(F.array_compact(F.array(*marks))).alias("x")).groupBy("x.number", "x.value").agg(F.count(F.lit(1)).alias("n"))
    ranks = [(number, max(1, _rank(q, n)) - before) for number, ((_, _, q, n, _, _), before) in enumerate(zip(asked, below))]
    wanted = spark.createDataFrame(ranks, "wanted int, rank bigint")
    # Values are many: cumulative counts come from parts of the value range, then inside one part.
    inside = checkpointed(inside)
    edges = inside.groupBy("number").agg(F.percentile_approx("value", [p / 64 for p in range(1, 64)], 1000).alias("edges"))
    placed = inside.join(F.broadcast(edges), "number").withColumn("part", F.size(F.filter("edges", lambda e: e < F.col("value"))))
    order = Window.partitionBy("number").orderBy("part")
    parts = placed.groupBy("number", "part").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(order))
    picked = parts.join(F.broadcast(wanted), F.col("number") == F.col("wanted")).where((F.col("rank") >= 1) & (F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto")))
    picked = picked.select("wanted", F.col("part").alias("own_part"), (F.col("rank") - (F.col("upto") - F.col("n"))).alias("left"))
    run = Window.partitionBy("number").orderBy("value")
    near = placed.join(F.broadcast(picked), (F.col("number") == F.col("wanted")) & (F.col("part") == F.col("own_part"))).withColumn("upto", F.sum("n").over(run))
    rows = near.where(F.col("upto") >= F.col("left")).groupBy("number").agg(F.min("value").alias("value")).collect()
    return {asked[r["number"]][:2]: r["value"] for r in rows}


def _rank(q: float, n: int) -> int:
    """The smallest rank that is at least the share ``q`` of ``n``, in exact arithmetic."""
    share = Fraction(repr(float(q)))
    return -(-share.numerator * n // share.denominator)
