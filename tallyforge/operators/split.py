"""Dividing rows into training and hold-out parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_STEPS = 1 << 32


def hold_out(key: str, share: float, seed: int = 0) -> Column:
    """True for about ``share`` of the keys; rows with a null key count as one key.

    It depends on key and seed only, not on row order or partitioning, so a lost task
    that runs again puts every row on the same side. MD5 makes it the same in any engine.
    """
    return _drawn(F.coalesce(F.col(key).cast("string"), F.lit("")), share, seed)


def _drawn(text: Column, share: float, seed: int) -> Column:
    digest = F.md5(F.concat(text, F.lit(f"/{seed}")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return place < int(share * _STEPS)


def key_split(df: DataFrame, key: str, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(training rows, hold-out rows) by key; rows of one key stay together."""
    held = hold_out(key, share, seed)
    return df.filter(~held), df.filter(held)


def random_split(df: DataFrame, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(training rows, hold-out rows) by a seeded draw per row."""
    train, held = df.randomSplit([1 - share, share], seed)
    return train, held


def split(
    df: DataFrame, share: float, key: str | None = None, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    return key_split(df, key, share, seed) if key else random_split(df, share, seed)


def with_mark(df: DataFrame, key: str | None, share: float, seed: int = 0) -> DataFrame:
    """``df`` with the hold-out mark as the column ``_held``: by the key, or without one by a
    hash of the whole row, so that every use of the table holds out the same rows."""
    if key:
        return df.withColumn("_held", hold_out(key, share, seed))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string")
    return df.withColumn("_held", _drawn(row, share, seed))


def marked_split(df: DataFrame, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(training rows, hold-out rows) by the mark, by a seeded draw if there is none."""
    if "_held" not in df.columns:
        return random_split(df, share, seed)
    return df.filter(~F.col("_held")).drop("_held"), df.filter("_held").drop("_held")
