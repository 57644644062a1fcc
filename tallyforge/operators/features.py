"""Categories to numbers, numbers to vectors."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.ml import Pipeline
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .joins import lookup_join


def index_stage(cols: Sequence[str], handle_invalid: str = "error") -> StringIndexer:
    """0 for the most frequent value, then by falling frequency, ties in alphabetical order."""
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[f"{c}_index" for c in cols],
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def encode_stage(cols: Sequence[str]) -> OneHotEncoder:
    """Indicator vectors of indexed columns, the last category being all zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_vector" for c in cols]
    )


def assemble_stage(cols: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=output)


def string_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<c>_index`` for each column, found in one pass over all of them."""
    return index_stage(cols).fit(df).transform(df)


def index_labels(df: DataFrame, index: str, output: str) -> DataFrame:
    """(index, label) for the indices in use; the labels come with the column."""
    return IndexToString(inputCol=index, outputCol=output).transform(df.select(index).distinct())


def one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<c>_index`` and ``<c>_vector`` for each column."""
    return Pipeline(stages=[index_stage(cols), encode_stage(cols)]).fit(df).transform(df)


def feature_stages(
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    encode: bool = True,
    handle_invalid: str = "error",
) -> list:
    """Stages ending in a column ``features``: numeric columns, then one indicator
    vector per categorical column (its plain index without ``encode``)."""
    stages: list = []
    if categorical:
        stages.append(index_stage(categorical, handle_invalid))
        if encode:
            stages.append(encode_stage(categorical))
    suffix = "vector" if encode else "index"
    stages.append(assemble_stage([*numeric, *[f"{c}_{suffix}" for c in categorical]]))
    return stages


def with_features(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), encode: bool = True
) -> DataFrame:
    """``df`` with a column ``features``, the categories being those of the whole table."""
    return Pipeline(stages=feature_stages(numeric, categorical, encode)).fit(df).transform(df)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """The entries of a vector column as plain columns."""
    entries = vector_to_array(F.col(vector))
    return df.withColumns({name: entries[i] for i, name in enumerate(names)})


def numbered(df: DataFrame, order: Sequence[Column], number: str) -> DataFrame:
    """``df`` with its rows numbered from 0 in the given order. Rows are sorted over all tasks,
    each task numbers its own, and the driver adds up one count per task."""
    part, row = F.shiftright("tf_at", 33), F.col("tf_at").bitwiseAND((1 << 33) - 1)
    placed = checkpointed(df.orderBy(*order).withColumn("tf_at", F.monotonically_increasing_id()))
    placed = placed.withColumns({"tf_part": part, "tf_row": row})
    sizes = sorted(placed.groupBy("tf_part").agg(F.max("tf_row").alias("last")).collect())
    starts = [0, *accumulate(r["last"] + 1 for r in sizes)]
    offsets = df.sparkSession.createDataFrame([(r["tf_part"], n) for r, n in zip(sizes, starts)], "tf_part long, tf_start long")
    joined = placed.join(F.broadcast(offsets), "tf_part")
    return joined.select(*df.columns, (F.col("tf_start") + F.col("tf_row")).alias(number))


def frequency_ranks(df: DataFrame, column: str, number: str = "rank") -> DataFrame:
    """(column, number): the different values but null, numbered from 0 by falling frequency,
    equal ones in alphabetical order: the numbers of ``StringIndexer`` without a label on the
    driver. Values are sorted over all tasks, each task numbers its own, and the driver adds up
    one count per task."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias(column)).agg(F.count(F.lit(1)).alias("tf_n"))
    return numbered(counts, [F.desc("tf_n"), F.asc(column)], number).select(column, number)


def rank_indexed(df: DataFrame, column: str, into: str) -> DataFrame:
    """``df`` with the number of its value in a new column (as a double, like an index; null for
    null). Few values are broadcast; with more of them the rows meet them in a join that splits
    frequent values."""
    ranks = frequency_ranks(df, column, "tf_rank").withColumnRenamed(column, "tf_value")
    keyed = df.withColumn("tf_value", F.col(column).cast("string"))
    joined = lookup_join(keyed, checkpointed(ranks), "tf_value", "left")
    return joined.withColumn(into, F.col("tf_rank").cast("double")).drop("tf_rank", "tf_value")
