"""Work that bounds save: inner products, and distances of shared cluster scans."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyforge.operators import inner_products
from tallyforge.plans import clusters, recommend, shared_clusters


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, features array<double>").repartition(3)


def _best(users, items, n):
    out = []
    for u, x in users:
        products = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in items)
        out += [(u, rank + 1, i, -p) for rank, (p, i) in enumerate(products[:n])]
    return sorted(out)


@pytest.mark.parametrize("pass_bytes", [1, 500, 32 << 20])
def test_products_are_those_of_all_pairs(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(inner_products, "PASS_BYTES", pass_bytes * 4)
    monkeypatch.setattr(inner_products, "BLOCK", (4, 3))
    r = random.Random(4)
    # Small whole numbers: many products are equal, some vectors are zero, some ids repeat.
    items = [(k % 55, [float(r.randrange(-3, 4)) * (1 + 9 * (k % 7 == 0)) for _ in range(3)]) for k in range(60 if pass_bytes > 1 else 12)]
    items.append((99, [0.0, 0.0, 0.0]))
    users = [(k, [float(r.randrange(-3, 4)) for _ in range(3)]) for k in range(20)] + [(20, [0.0] * 3)]
    got = inner_products.best_products(_vectors(spark, users), _vectors(spark, items), 4).collect()
    assert sorted((x["id"], x["rank"], x["item"], x["score"]) for x in got) == _best(users, items, 4)
    few = inner_products.best_products(_vectors(spark, users), _vectors(spark, items[:2]), 4).collect()
    assert sorted((x["id"], x["rank"], x["item"], x["score"]) for x in few) == _best(users, items[:2], 4)


@pytest.mark.parametrize("pass_bytes", [2000, 32 << 20])
def test_all_pairs_without_bounds(spark, monkeypatch, pass_bytes):
    """Every item is multiplied, also for users of zeros, in one pass or in some."""
    monkeypatch.setattr(inner_products, "PASS_BYTES", pass_bytes)
    r = random.Random(9)
    items = [(k, [float(r.randrange(-3, 4)) * (1 + 9 * (k % 7 == 0)) for _ in range(3)]) for k in range(120)]
    users = [(k, [float(r.randrange(-3, 4)) for _ in range(3)]) for k in range(20)] + [(20, [0.0] * 3)]
    got = inner_products.best_products(_vectors(spark, users), _vectors(spark, items), 4, bounded=False).collect()
    assert sorted((x["id"], x["rank"], x["item"], x["score"]) for x in got) == _best(users, items, 4)
    assert {x["n_scored"] for x in got} == {120}


def test_no_query_shuffles_lists_per_block(spark, monkeypatch):
    """Spark's own top lists cost a shuffled row for each user and block of items."""
    def refused(*_):
        raise AssertionError("all pairs by blocks")

    for name in ("recommendForAllUsers", "recommendForUserSubset"):
        monkeypatch.setattr(recommend.ALSModel, name, refused)
    ratings = spark.createDataFrame([(u, i, 1.0 + (u * i) % 5) for u in range(8) for i in range(u % 3, 12, 2)], "userId int, courseId int, rating double")
    some = ratings.where("userId < 3").select("userId")
    for options in ({}, {"pruned": False}):
        assert recommend.recommend(ratings, 4, iterations=2, **options).count() == 8
        assert recommend.recommend(ratings, 4, users=some, iterations=2, **options).count() == 3


def test_rows_that_take_no_part(spark):
    odd = [(None, [1.0, 1.0]), (7, None), (8, [1.0, None]), (9, [float("nan"), 0.0]), (10, [float("inf"), 0.0])]
    users, items = _vectors(spark, [(1, [1.0, 2.0]), *odd]), _vectors(spark, [(5, [3.0, 4.0]), *odd])
    got = inner_products.best_products(users, items).collect()
    assert [tuple(x) for x in got] == [(1, 1, 5, 11.0, 1)]
    assert inner_products.best_products(users, items.limit(0)).collect() == []
    assert inner_products.best_products(users.limit(0), items).collect() == []
    with pytest.raises(ValueError, match="width|numbers"):
        inner_products.best_products(users, _vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_long_items_end_the_search(spark):
    r = np.random.default_rng(5)
    directions = r.normal(size=(3000, 4))
    items = [(k, (v * (100.0 if k < 50 else 1.0)).tolist()) for k, v in enumerate(directions)]
    users = [(k, v.tolist()) for k, v in enumerate(r.normal(size=(40, 4)))]
    got = inner_products.best_products(_vectors(spark, users), _vectors(spark, items), 3).collect()
    assert len(got) == 120 and max(x["n_scored"] for x in got) <= 2 * inner_products.BLOCK[0]


def test_recommendations_are_those_of_all_pairs(spark):
    r = random.Random(6)
    rows = [(u, i, float(r.randrange(1, 6))) for u in range(30) for i in r.sample(range(40), 9)]
    ratings = spark.createDataFrame(rows, "userId int, courseId int, rating double")
    model = recommend.fit_ratings(ratings, iterations=3)
    full = {x.userId: x.recommendations for x in model.recommendForAllUsers(5).collect()}
    for users, wanted in ((None, full.keys()), (ratings.where("userId < 4").select("userId").distinct(), range(4))):
        got = {x.userId: x.recommendations for x in recommend.best_for_all(model, 5, users).collect()}
        assert set(got) == set(wanted)
        for u, found in got.items():
            assert [x.rating for x in found] == pytest.approx([x.rating for x in full[u]], rel=1e-5)
            assert [x.courseId for x in found] == [x.courseId for x in full[u]]
    pruned = recommend.recommend(ratings, 5, iterations=3, pruned=True)
    plain = recommend.recommend(ratings, 5, iterations=3)
    assert pruned.count() == plain.count() == 30 and pruned.columns == plain.columns


def _labelled(spark, points, parts=4):
    return spark.createDataFrame([(p.tolist(),) for p in points], "features array<double>").repartition(parts)


def test_shared_scans_are_no_worse_than_single_fits(spark):
    r = np.random.default_rng(7)
    points = np.concatenate([r.normal(size=(150, 5)) + 6 * r.normal(size=5) for _ in range(6)])
    df = _labelled(spark, points)
    shared = {x.k: x for x in shared_clusters.kmeans_shared(df).collect()}
    single = {x.k: x for x in clusters.kmeans_sweep(df.select(array_to_vector("features").alias("features")), features="features").collect()}
    assert sorted(shared) == sorted(single) == list(range(2, 9))
    for k, row in shared.items():
        assert row.sse <= single[k].sse * (1 + 1e-6) and sum(row.sizes) == len(points)
        near = ((points[:, None] - np.array(row.centres)) ** 2).sum(axis=2)
        assert row.sse == pytest.approx(near.min(axis=1).sum())
        assert sorted(row.sizes) == sorted(np.bincount(near.argmin(axis=1)).tolist())
    if abs(shared[6].sse - single[6].sse) < 1e-6 * single[6].sse:
        assert shared[6].silhouette == pytest.approx(single[6].silhouette)
    every = shared[2].scans * len(points) * 3 * sum(range(2, 9))
    assert shared[2].scans <= 47 and shared[2].distances < 0.6 * every


def test_bounds_leave_the_nearest_centre(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(500, 3))
    sets = [r.normal(size=(k, 3)) for k in (8, 5, 2, 1)] + [x[:6]]
    sets[1][3] = sets[1][1]  # two centres at one place
    labels, squares, made = shared_clusters._Sets(sets).place(x)
    for label, square, centres in zip(labels, squares, sets):
        near = ((x[:, None] - centres) ** 2).sum(axis=2)
        assert np.array_equal(square, near.min(axis=1)) and np.array_equal(near[np.arange(500), label], square)
    assert made < 500 * sum(map(len, sets))


def test_few_rows_and_odd_rows(spark):
    rows = [([1.0, 1.0],)] * 5 + [([4.0, 5.0],)] * 2 + [(None,), ([1.0, None],), ([float("nan"), 1.0],)]
    df = spark.createDataFrame(rows, "features array<double>")
    got = shared_clusters.kmeans_shared(df, ks=[1, 2, 3]).collect()
    assert [(x.k, round(x.sse, 9), sorted(x.sizes)) for x in got] == [(1, round(25 * 10 / 7, 9), [7]), (2, 0.0, [2, 5]), (3, 0.0, [2, 5])]
    assert [x.silhouette for x in got] == [0.0, 1.0, 1.0]
    assert shared_clusters.kmeans_shared(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        shared_clusters.kmeans_shared(df, ks=[0])


def test_blocks_of_the_fit_grow_with_the_ratings(spark, monkeypatch):
    """A task holds one block: its ratings are bounded, and so are the shuffles on the disk."""
    made, real = [], recommend.ALS

    def recorded(**options):
        made.append(options)
        return real(**options)

    monkeypatch.setattr(recommend, "ALS", recorded)
    r = random.Random(10)
    rows = [(u, i, float(r.randrange(1, 6))) for u in range(60) for i in r.sample(range(40), 9)]
    ratings = spark.createDataFrame(rows, "userId int, courseId int, rating double")
    few = recommend.recommend(ratings, 5, iterations=3).collect()
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 20, raising=False)
    monkeypatch.setattr(recommend, "FEW_RATINGS", 100, raising=False)
    many = recommend.recommend(ratings, 5, iterations=3).collect()
    cores = spark.sparkContext.defaultParallelism
    assert [x["numUserBlocks"] for x in made] == [x["numItemBlocks"] for x in made] == [max(10, cores), max(10, cores, 27)]
    assert [x["checkpointInterval"] for x in made] == [10, 1]
    assert len(few) == len(many) == 60 and all(len(x.recommendations) == 5 for x in many)
    model = recommend.fit_ratings(ratings, iterations=3)
    assert made[-1]["numUserBlocks"] == max(10, cores, 27)
    users, items = ({x.id: np.array(x.features) for x in f.collect()} for f in (model.userFactors, model.itemFactors))
    for x in recommend.best_for_all(model, 5).collect():
        best = sorted((float(users[x.userId] @ v) for v in items.values()), reverse=True)[:5]
        assert [y.rating for y in x.recommendations] == pytest.approx(best, rel=1e-4)


@pytest.mark.parametrize("bounded", [True, False])
def test_lists_of_earlier_passes_go(spark, monkeypatch, bounded):
    """Each pass writes the lists of all users that are not done: only the last ones stay."""
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "tallyforge"
    monkeypatch.setattr(inner_products, "PASS_BYTES", 40 * 8)
    r = random.Random(11)
    items = [(k, [float(r.randrange(-3, 4)) for _ in range(3)]) for k in range(80)]
    users = [(k, [float(r.randrange(-3, 4)) for _ in range(3)]) for k in range(20)] + [(20, [0.0] * 3)]
    before = {p for p in root.glob("table-*") if p.is_dir()}
    got = inner_products.best_products(_vectors(spark, users), _vectors(spark, items), 4, bounded=bounded).collect()
    assert sorted((x["id"], x["rank"], x["item"], x["score"]) for x in got) == _best(users, items, 4)
    held = [p for p in root.glob("table-*") if p.is_dir() and p not in before and any("vector" in x.name for x in pq.read_schema(next(p.glob("*.parquet"))))]
    assert len(held) <= 3  # the items twice, numbered and not, and the last lists
