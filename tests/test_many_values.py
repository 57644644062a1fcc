"""Columns with more values than a driver, or a table's width, can hold."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import crosstab, features, joins, profile


@pytest.mark.parametrize("small", [True, False])
def test_ranks_are_those_of_the_indexer(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(joins, "is_small", lambda *_: False)
    r = random.Random(1)
    rows = [(k, f"v{int(r.paretovariate(0.8)) % 300}") for k in range(2000)]
    df = spark.createDataFrame(rows, "id long, name string").repartition(5)
    expected = {x.id: x.name_index for x in features.string_index(df, ["name"]).collect()}
    got = features.rank_indexed(df.union(spark.createDataFrame([(-1, None)], df.schema)), "name", "n").collect()
    assert {x.id: x.n for x in got} == {**expected, -1: None} and len(got) == 2001
    assert features.frequency_ranks(df.limit(0), "name").count() == 0


def test_sparse_pivot_is_the_wide_one(spark):
    r = random.Random(2)
    rows = [(r.randrange(30), f"i{r.randrange(50)}", r.choice([1, 2, None])) for _ in range(400)] + [(99, None, 5), (98, "i1", None)]
    df = spark.createDataFrame(rows, "who long, item string, n long").repartition(4)
    vectors, names = crosstab.pivot_sparse(df, "who", "item", "n")
    item = {x["rank"]: x["item"] for x in names.collect()}
    wide = {x.who: {c: v for c, v in x.asDict().items() if c not in ("who", "null") and v is not None} for x in crosstab.pivot_sum(df.where("item is not null"), "who", "item", "n").collect()}
    got = {x.who: {item[k]: v for k, v in zip(x.indices, x["values"])} for x in vectors.collect()}
    assert got == {who: v for who, v in wide.items() if v} and sorted(item) == list(range(len(item)))


def test_a_hundred_thousand_items(spark):
    df = spark.range(200_000).select((F.col("id") % 1000).alias("who"), (F.col("id") % 100_000).alias("item"), F.lit(1).alias("n"))
    vectors, names = crosstab.pivot_sparse(df, "who", "item", "n")
    row = vectors.where("who = 7").first()
    assert names.count() == 100_000 and row["size"] == 100_000 and len(row.indices) == 100 and set(row["values"]) == {2}


def test_bitmaps_count_keys(spark):
    r = random.Random(3)
    keys = [r.choice([r.randrange(-50, 50), r.randrange(-(1 << 62), 1 << 62), None, 7]) for _ in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    for part in (df, df.where("k is not null"), df.where("k = 7"), df.limit(0)):
        assert profile.integer_key_count(part, "k").first()["keys"] == profile.key_count(part, "k").first()["keys"]
