"""Batch sources: CSV, delimited text, plain text, literal tables, views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header line; ``path`` may be a file, a folder, a glob or a list.

    With neither ``schema`` nor ``infer`` every column is a string. Prefer a schema
    for large input: inference reads all of it once more.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str, sep: str = ","
) -> DataFrame:
    """Headerless delimited text with typed columns.

    ``schema`` names the leading fields to keep; further fields of a line are ignored. A
    missing field, or text that does not fit its type, fails the job.
    """
    fields = F.split("value", re.escape(sep))
    return spark.read.text(path).select(
        *[
            fields[i].cast(f.dataType).alias(f.name)
            for i, f in enumerate(StructType.fromDDL(schema).fields)
        ]
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines in a column ``value``."""
    return spark.read.text(path)


def stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Stop-word list, one word per line, in a column ``word``."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def literal_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table written out in the program."""
    return spark.createDataFrame(rows, schema)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a table or stream available to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` (a file or a folder of files) in ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
