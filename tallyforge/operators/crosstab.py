"""Counts and statistics by two categories, as rows or pivoted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import MONTHS, as_double, as_timestamp, fill_numeric, name_of_month
from ..session import checkpointed
from .features import frequency_ranks
from .joins import lookup_join


def month_counts(df: DataFrame, level: str, ts: str) -> DataFrame:
    """(level, month, total) in calendar order, then by level.

    Rows are grouped by the month's number; names are made for the few groups only.
    """
    return (
        df.select(F.col(level).alias("level"), F.month(as_timestamp(df, ts)).alias("m"))
        .groupBy("level", "m")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy("m", "level")
        .select("level", name_of_month("m").alias("month"), "total")
    )


def month_counts_sql(spark: SparkSession, view: str, level: str = "level", ts: str = "datetime") -> DataFrame:
    """The same report as SQL text over a registered view. A null or unreadable timestamp has
    a null month in both."""
    names = ", ".join(f"'{m}'" for m in MONTHS)
    return spark.sql(
        f"""
        WITH monthly AS (
            SELECT {level} AS level, month(try_cast({ts} AS timestamp)) AS m, count(*) AS total
            FROM {view}
            GROUP BY ALL
        )
        SELECT level, CASE WHEN m IS NOT NULL THEN element_at(array({names}), m) END AS month, total
        FROM monthly
        ORDER BY m, level
        """
    )


def month_pivot(df: DataFrame, level: str, ts: str, months: Sequence[str] = MONTHS) -> DataFrame:
    """One row per level, one count column per listed month, 0 where nothing was seen.

    A level seen only in other months keeps its row.
    """
    numbers = [MONTHS.index(m) + 1 for m in months]
    counted = (
        df.select(F.col(level), F.month(as_timestamp(df, ts)).alias("m"))
        .groupBy(level)
        .pivot("m", numbers)
        .count()
        .na.fill(0)
    )
    return counted.toDF(level, *months)


def pivot_stats(
    df: DataFrame,
    row: str,
    column: str,
    value: str,
    values: Sequence | None = None,
    digits: int = 2,
) -> DataFrame:
    """Mean and sample deviation of ``value`` per row key, a pair of columns
    ``<v>_average``, ``<v>_stddev`` for each value v of ``column``; 0 where undefined.

    Without ``values`` the columns are those found in the data, sorted. Then the
    grouped statistics are checkpointed first: the search for the values and the
    pivot both read that small table, and the input is scanned once.
    """
    stats = (
        df.select(F.col(row), F.col(column), as_double(df, value).alias("_v"))
        .groupBy(row, column)
        .agg(
            F.round(F.avg("_v"), digits).alias("average"),
            F.round(F.stddev("_v"), digits).alias("stddev"),
        )
    )
    if values is None:
        stats = checkpointed(stats)
    pivoted = stats.groupBy(row).pivot(column, list(values) if values is not None else None).agg(
        F.max("average").alias("average"), F.max("stddev").alias("stddev")
    )
    return fill_numeric(pivoted)


def pivot_sum(
    df: DataFrame, row: str, column: str, value: str, values: Sequence | None = None
) -> DataFrame:
    """Sum of ``value`` per row key and column value, one column per value, null where none."""
    sums = df.groupBy(row, column).agg(F.sum(value).alias("_s"))
    if values is None:
        sums = checkpointed(sums)
    return sums.groupBy(row).pivot(column, list(values) if values is not None else None).agg(F.sum("_s"))


def pivot_sparse(df: DataFrame, row: str, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """The sums of ``pivot_sum`` for any number of column values, as sparse vectors.

    The first table has (row, size, indices, values): indices ascending, of the column values
    that the row key has, among ``size``. The second names the indices (column, rank), the most
    frequent value first. Sums of nulls alone are null and left out, as are null column values.
    The names never reach the driver; a row key's vector has as many entries as it has items.
    """
    known = df.where(F.col(column).isNotNull())
    names = checkpointed(frequency_ranks(known, column))
    sums = known.groupBy(row, F.col(column).cast("string").alias(column)).agg(F.sum(value).alias("tf_sum")).where("tf_sum is not null")
    placed = lookup_join(sums, names, column)
    entry = F.sort_array(F.collect_list(F.struct("rank", "tf_sum")))
    size = names.agg(F.count(F.lit(1)).alias("size"))
    vectors = placed.groupBy(row).agg(entry.alias("tf_entries")).select(
        row, F.lit(size.first()["size"]).cast("bigint").alias("size"), F.col("tf_entries.rank").alias("indices"), F.col("tf_entries.tf_sum").alias("values")
    )
    return vectors, names
