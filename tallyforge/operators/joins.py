"""Joins of a large table with a lookup table whose size is not known beforehand.

``lookup_join`` measures the lookup side and broadcasts it when it is small. Beyond
that it shuffles, after splitting the keys that hold a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    FractionalType,
    IntegralType,
    MapType,
    StringType,
    StructType,
    UserDefinedType,
)

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is split when it holds more than 1/HOT_SHARE of the rows, so at most
# HOT_SHARE keys can be hot, whatever the size of the table.
HOT_SHARE = 200
_TRACKED = 10_000


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Exact row count and an estimate of the bytes a broadcast of ``df`` takes.

    One scan of the table's columns with a partial aggregate per task.
    """
    lengths = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType, UserDefinedType)):
            # A number takes two bytes of JSON at least, and 16 in memory at most.
            lengths.append(8 * F.octet_length(F.to_json(F.struct(f.name))))
        elif isinstance(f.dataType, (StringType, BinaryType)):
            lengths.append(F.octet_length(f.name))
    lengths = [F.coalesce(F.sum(n), F.lit(0)) for n in lengths]
    row = df.agg(F.count(F.lit(1)).alias("n"), reduce(add, lengths, F.lit(0)).alias("b")).first()
    return row["n"], row["b"] + row["n"] * 16 * len(df.columns)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    sketch: DataFrame | None = None,
    skewed: bool = True,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fact`` with ``dim`` on equal column names; ``how`` must keep rows of the
    fact side (inner, left, left_semi, left_anti).

    ``spread`` names fact columns that tell rows of one key apart (all other columns
    if not given); hot keys are split by their hash when ``dim`` has to be shuffled.
    ``sketch`` is a table to look for hot keys in, if one with about the same keys is
    cheaper to read than ``fact``. Pass ``skewed=False`` where a key has one fact row.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join kind {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    _check_keys(fact, dim, keys)
    if is_small(dim, max_rows, max_bytes):
        return fact.join(F.broadcast(dim), keys, how)
    if not skewed:
        return fact.join(dim, keys, how)
    return salted_join(fact, dim, keys, how, spread, sketch)


def _check_keys(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> None:
    """Keys that could not be hashed alike on both sides are refused, whatever the sizes."""
    for key in keys:
        kinds = [df.schema[key].dataType for df in (fact, dim)]
        if any(isinstance(kind, FractionalType) for kind in kinds):
            raise ValueError(f"join key {key!r} is fractional: cast it first")
        if kinds[0] != kinds[1] and not all(isinstance(kind, IntegralType) for kind in kinds):
            raise ValueError(f"join key {key!r} has different types: {kinds[0]}, {kinds[1]}")


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the key columns, the same for equal keys of different integer types."""
    parts = []
    for key in keys:
        kind = df.schema[key].dataType
        if isinstance(kind, FractionalType):
            raise ValueError(f"join key {key!r} is fractional: cast it first")
        parts.append(F.col(key).cast("long") if isinstance(kind, IntegralType) else F.col(key))
    return F.xxhash64(*parts)


def _same_kind(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> bool:
    return all(
        a.schema[k].dataType == b.schema[k].dataType
        or (isinstance(a.schema[k].dataType, IntegralType) and isinstance(b.schema[k].dataType, IntegralType))
        for k in keys
    )


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> list[tuple[int, int]]:
    """(key hash, number of salts) of the keys holding more than 1/``share`` of the rows.

    A bounded sketch finds them in one pass; its counts only steer the split, so an
    error in them costs balance, never a row.
    """
    top = df.select(_key_hash(df, keys).alias("h")).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(h, {share}, {_TRACKED})").alias("top"),
    ).first()
    if not top["n"]:
        return []
    bound = top["n"] / share
    return [(t["item"], int(-(-t["count"] // bound))) for t in top["top"] if t["count"] > bound]


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    sketch: DataFrame | None = None,
    share: int = HOT_SHARE,
) -> DataFrame:
    """Shuffle join in which each hot key of ``fact`` is split over several partitions.

    A hot key gets as many salts as it holds 1/``share`` parts of the rows. Its fact
    rows take one salt each, by hash; its lookup rows are repeated once per salt. Both
    lists are bounded by ``share``, so the salt table can always be broadcast.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not _same_kind(fact, dim, keys):
        raise ValueError(f"join keys {keys} differ in type: cast one side")
    hot = hot_keys(sketch if sketch is not None else fact, keys, share)
    if not hot:
        return fact.join(dim, keys, how)
    spark = fact.sparkSession
    salts = F.broadcast(spark.createDataFrame(hot, "_hash long, _salts int"))
    apart = list(spread) if spread else [c for c in fact.columns if c not in keys]
    salted_fact = (
        fact.withColumn("_hash", _key_hash(fact, keys))
        .join(salts, "_hash", "left")
        .withColumn(
            "_salt",
            F.pmod(F.xxhash64(*(apart or keys)), F.coalesce("_salts", F.lit(1))).cast("int"),
        )
        .drop("_hash", "_salts")
    )
    salted_dim = (
        dim.withColumn("_hash", _key_hash(dim, keys))
        .join(salts, "_hash", "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)),
        )
        .drop("_hash", "_salts")
    )
    return salted_fact.join(salted_dim, [*keys, "_salt"], how).drop("_salt")
