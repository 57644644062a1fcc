import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyforge.operators import features as feat, metrics, split
from tallyforge.plans import gym, house_prices, recommend, trials, tuning, viewing
from tallyforge.session import checkpointed

from .fixtures import GYM, GYM_SCHEMA, rows


@pytest.fixture(scope="module")
def competitors(spark):
    return spark.createDataFrame(GYM, GYM_SCHEMA).coalesce(1)


# --- features ----------------------------------------------------------------------


def test_index_by_frequency_then_alphabet(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacccd"], "c string")
    found = dict(rows(feat.string_index(df, ["c"]).select("c", "c_index").distinct()))
    assert found == {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0}


def test_index_labels(spark):
    df = feat.string_index(spark.createDataFrame([("x",), ("x",), ("y",)], "c string"), ["c"])
    assert sorted(rows(feat.index_labels(df, "c_index", "name"))) == [(0.0, "x"), (1.0, "y")]


def test_one_hot_drops_the_last_category(spark):
    df = feat.one_hot(spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "c string"), ["c"])
    found = feat.vector_columns(df, "c_vector", ["v0", "v1"]).select("c", "v0", "v1").distinct()
    assert sorted(rows(found)) == [("x", 1.0, 0.0), ("y", 0.0, 1.0), ("z", 0.0, 0.0)]


def test_features_of_numbers_and_categories(spark):
    df = spark.createDataFrame([(1, 2.5, 7), (3, 0.5, 7), (4, 0.0, 12)], "a int, b double, c int")
    full = feat.with_features(df, ["a", "b"], ["c"]).select("a", vector_to_array("features").alias("v"))
    assert {a: v for a, v in rows(full)}[3] == [3.0, 0.5, 1.0]
    plain = feat.with_features(df, ["a"], ["c"], encode=False).select(vector_to_array("features").alias("v"))
    assert sorted(v for (v,) in rows(plain)) == [[1.0, 0.0], [3.0, 0.0], [4.0, 1.0]]


def test_key_split_depends_on_the_key_only(spark):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    train, held = split.key_split(df, "k", 0.2, seed=3)
    a, b = {r[0] for r in rows(train)}, {r[0] for r in rows(held)}
    assert not a & b and len(a | b) == 10_000
    assert 1850 < len(b) < 2150
    again = split.key_split(df.repartition(7).orderBy(F.desc("k")), "k", 0.2, seed=3)[1]
    assert {r[0] for r in rows(again)} == b
    assert {r[0] for r in rows(split.key_split(df, "k", 0.2, seed=4)[1])} != b


def test_random_split_is_whole(spark):
    df = spark.range(1000)
    train, held = split.split(df, 0.1, seed=5)
    assert train.count() + held.count() == 1000
    assert train.intersect(held).count() == 0


# --- metrics -----------------------------------------------------------------------


def test_regression_metrics_agree_with_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5)], "label double, prediction double")
    found = metrics.regression_metrics(df).first()
    for name in ("rmse", "r2"):
        assert found[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))


def test_classifier_metrics(spark):
    cells = [(1, 1.0)] * 6 + [(1, 0.0)] * 2 + [(0, 1.0)] * 1 + [(0, 0.0)] * 3
    df = spark.createDataFrame(cells, "label int, prediction double")
    assert sorted(rows(metrics.confusion(df))) == [(0, 0.0, 3), (0, 1.0, 1), (1, 0.0, 2), (1, 1.0, 6)]
    assert rows(metrics.accuracy(df)) == [(12, 0.75)]
    assert rows(metrics.class_rates(df)) == [(0, 0.75, 0.25), (1, 0.75, 0.25)]
    found = metrics.class_likelihoods(df).first().asDict()
    assert found == {
        "accuracy": 0.75, "recall_pos": 0.75, "recall_neg": 0.75,
        "likelihood_pos": 0.75, "likelihood_neg": 0.75,
    }


def test_rates_of_a_missing_class_are_null(spark):
    df = spark.createDataFrame([(1, 1.0)], "label int, prediction double")
    assert rows(metrics.class_rates(df)) == [(0, None, 0.0), (1, 1.0, None)]


def test_silhouette_by_brute_force(spark):
    points = [([0.0, 0.0], 0.0), ([1.0, 0.0], 0.0), ([5.0, 5.0], 1.0), ([6.0, 5.0], 1.0), ([9.0, 0.0], 2.0)]
    df = spark.createDataFrame(points, "v array<double>, prediction double")
    found = metrics.silhouette(df.select(array_to_vector("v").alias("features"), "prediction"))

    def apart(p, group):
        return sum(sum((a - b) ** 2 for a, b in zip(p, q)) for q in group)

    scores = []
    for v, own in points:
        groups = {c: [q for q, k in points if k == c] for c in {k for _, k in points}}
        if len(groups[own]) == 1:
            scores.append(0.0)
            continue
        a = apart(v, groups[own]) / (len(groups[own]) - 1)
        b = min(apart(v, g) / len(g) for c, g in groups.items() if c != own)
        scores.append((b - a) / max(a, b))
    assert found == pytest.approx(sum(scores) / len(scores))


# --- jobs --------------------------------------------------------------------------


def test_gym_regression(competitors):
    fit = gym.reps_model(competitors)
    intercept, coefficients = rows(fit.coefficients)[0]
    assert intercept == pytest.approx(34.4764, abs=1e-3)
    assert coefficients == pytest.approx([0.0441, -0.0803, 0.3961, -0.2236], abs=1e-3)
    found = metrics.regression_metrics(fit.predictions).first()
    assert found["rmse"] == pytest.approx(1.6696, abs=1e-3)
    assert found["r2"] == pytest.approx(0.8406, abs=1e-3)
    # The least-squares solution by another way. Women are category 0.
    x = np.array([[1, r[2], r[3], r[4], r[1] == "F"] for r in GYM], dtype=float)
    solved = np.linalg.lstsq(x, np.array([r[5] for r in GYM], dtype=float), rcond=None)[0]
    assert [intercept, *coefficients] == pytest.approx(list(solved), abs=1e-6)


def test_gym_clusters(competitors):
    found = {r["k"]: r for r in gym.competitor_clusters(competitors).collect()}
    assert sorted(found) == list(range(2, 9))
    for k, r in found.items():
        assert len(r["sizes"]) == k and sum(r["sizes"]) == 20
        assert len(r["centres"]) == k and all(len(c) == 5 for c in r["centres"])
        assert -1 <= r["silhouette"] <= 1
    assert found[2]["sse"] > found[8]["sse"]
    # The reported error is that of the reported centres.
    points = [[r[2], r[3], r[4], r[5], r[1] == "F"] for r in GYM]
    for r in found.values():
        best = [min(sum((a - b) ** 2 for a, b in zip(p, c)) for c in r["centres"]) for p in points]
        assert sum(best) == pytest.approx(r["sse"], rel=1e-6)


def houses(spark, n=400):
    df = spark.range(n).select(
        "id",
        F.lit("20141013T000000").alias("date"),
        (1 + F.col("id") % 5).cast("int").alias("bedrooms"),
        (1 + F.col("id") % 3).cast("double").alias("bathrooms"),
        (800 + (F.col("id") * 37) % 1700).alias("sqft_living"),
        (500 + (F.col("id") * 17) % 700).alias("sqft_above"),
        (1 + F.col("id") % 2).cast("double").alias("floors"),
        (F.col("id") % 11 == 0).cast("int").alias("waterfront"),
        (1 + F.col("id") % 4).alias("condition"),
        (5 + F.col("id") % 6).alias("grade"),
        (98000 + F.col("id") % 7).alias("zipcode"),
    )
    for c in ("view", "yr_renovated", "lat", "long", "sqft_lot", "sqft_lot15", "yr_built", "sqft_living15"):
        df = df.withColumn(c, (F.col("id") * 13 % 29).cast("double"))
    noise = (F.col("id") * 7919 % 101 - 50) * 20
    return df.withColumn(
        "price", F.col("sqft_living") * 200 + F.col("bedrooms") * 5000 + F.col("grade") * 10_000 + noise
    )


@pytest.mark.parametrize("model", [house_prices.price_model, house_prices.price_pipeline])
def test_house_prices(spark, model):
    df = houses(spark)
    found = model(df, key="id")
    report, grid = found.report.first(), found.grid.collect()
    assert len(grid) == 9
    assert {(r["reg_param"], r["elastic_net_param"]) for r in grid} == {
        (r, e) for r in (0.01, 0.1, 0.5) for e in (0.0, 0.5, 1.0)
    }
    best = max(grid, key=lambda r: r["metric"])
    assert (report["reg_param"], report["elastic_net_param"]) == (best["reg_param"], best["elastic_net_param"])
    assert report["r2_train"] > 0.99 and report["r2_holdout"] > 0.99
    again = metrics.regression_metrics(found.predictions).first()
    assert again["rmse"] == pytest.approx(report["rmse_holdout"])
    assert again["r2"] == pytest.approx(report["r2_holdout"])
    assert found.predictions.count() == split.key_split(df, "id", 0.2, 42)[1].count()


def test_house_correlations(spark):
    df = houses(spark)
    weak = {b for _, b, _ in rows(house_prices.price_correlations(df))}
    assert {"price", "sqft_lot", "sqft_living"} <= weak and not {"id", "view", "lat"} & weak
    kept = {a for a, _, _ in rows(house_prices.feature_correlations(df))}
    assert "sqft_living" in kept and "sqft_lot" not in kept


def test_pipeline_scores_unseen_categories(spark):
    df = spark.range(300).select(
        "id", (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 17 * 2.0).alias("y"),
        F.when(split.hold_out("id", 0.2, 42), "new").otherwise("old").alias("c"),
    ).union(spark.createDataFrame([(1000 + i, float(i), 2.0 * i, "other") for i in range(40)], "id long, x double, y double, c string"))
    found = tuning.tune_linreg_pipeline(df, "y", ["x"], ["c"], reg=[0.01], elastic=[0.0], key="id")
    assert found.predictions.filter("c = 'new'").count() > 30
    assert found.report.first()["r2_holdout"] > 0.9


def viewers(spark, n=600):
    i = F.col("id")
    return spark.range(n).select(
        "id",
        (i % 10 == 0).alias("is_cancelled"),
        F.lit("2018-01-01").alias("observation_date"),
        F.when(i % 4 == 0, None).otherwise(i % 3).cast("int").alias("firstSub"),
        (20 + i % 40).cast("int").alias("age"),
        F.when(i % 7 == 0, None).otherwise(i % 50).cast("int").alias("all_time_views"),
        F.when(i % 5 == 0, None).otherwise(i % 9).cast("int").alias("last_month_views"),
        F.when(i % 9 < 4, None).when(i % 9 == 4, 0).otherwise(i % 9).cast("int").alias("next_month_views"),
        F.element_at(F.array(F.lit("card"), F.lit("paypal")), (i % 2 + 1).cast("int")).alias("payment_method_type"),
        F.element_at(F.array(F.lit("GB"), F.lit("US"), F.lit("IN")), (i % 3 + 1).cast("int")).alias("country"),
        F.element_at(F.array(F.lit(1), F.lit(12)), (i % 2 + 1).cast("int")).alias("rebill_period_in_months"),
    )


def test_viewing_preparation(spark):
    df = viewers(spark)
    views, churn = viewing.prepare_views(df), viewing.prepare_churn(df)
    assert views.count() == churn.count() == 540
    assert not {"is_cancelled", "observation_date"} & set(views.columns)
    for c in ("firstSub", "all_time_views", "last_month_views", "next_month_views"):
        assert views.filter(F.col(c).isNull()).count() == 0
    both = views.select("id", F.col("next_month_views").alias("n")).join(churn, "id")
    assert both.filter("(n > 0 AND next_month_views <> 0) OR (n = 0 AND next_month_views <> 1)").count() == 0


def test_next_month_views(spark):
    found = viewing.next_month_views(viewers(spark), key="id", elastic=[0.0])
    assert found.grid.count() == 5
    report = found.report.first()
    assert len(report["coefficients"]) == 4 + 1 + 2 + 1
    assert report["r2_train"] <= 1 and report["rmse_holdout"] > 0


@pytest.mark.parametrize("metric", ["areaUnderROC", "r2"])
def test_stop_watching(spark, metric):
    found = viewing.stop_watching(viewers(spark), key="id", reg=[0.01, 0.1], elastic=[0.0], metric=metric)
    report = found.report.first()
    cells = {(r["label"], r["prediction"]): r["count"] for r in found.confusion.collect()}
    total = sum(cells.values())
    right = cells.get((1.0, 1.0), 0) + cells.get((0.0, 0.0), 0)
    assert report["accuracy_holdout"] == pytest.approx(right / total)
    positives = cells.get((1.0, 1.0), 0) + cells.get((1.0, 0.0), 0)
    assert report["recall_pos"] == pytest.approx(cells.get((1.0, 1.0), 0) / positives)
    rates = {r["label"]: r for r in found.rates.collect()}
    assert rates[1]["tpr"] == pytest.approx(report["recall_pos"])
    expected = rates[1]["tpr"] / (rates[1]["tpr"] + rates[1]["fpr"])
    assert report["likelihood_pos"] == pytest.approx(expected)
    assert found.grid.count() == 2


def test_pay_after_trial(spark):
    i = F.col("id")
    codes = ["US", "US", "US", "DE", "GR", "UNKNOWN", "IN", "GB"]
    df = spark.range(500).select(
        "id",
        F.element_at(F.array(*[F.lit(c) for c in codes]), (i % 8 + 1).cast("int")).alias("country"),
        (1 + i % 3).cast("int").alias("rebill_period"),
        F.when((i * 31 % 100 > 40) & (i % 8 != 4), 2).otherwise(0).alias("payments_made"),
        (i * 31 % 100).cast("int").alias("chapter_access_count"),
        (i * 17 % 4000).cast("int").alias("seconds_watched"),
    )
    groups = dict(rows(trials.trial_rows(df).groupBy("country").count()))
    assert groups["EUROPE"] == 63 and groups["OTHER"] == 62
    found = {r["model"]: r for r in trials.pay_after_trial(df, key="id").collect()}
    assert set(found) == {"tree", "forest"}
    # The label follows from two features, one of them nominal, up to the width of a bin.
    assert found["tree"]["accuracy"] > 0.95
    assert found["forest"]["accuracy"] > 0.9
    assert "in {" in found["tree"]["rules"]
    assert "numTrees=20" in found["forest"]["rules"]
    assert found["tree"]["holdout_rows"] == found["forest"]["holdout_rows"]


def ratings(spark):
    data = [(u, c, float((u * c) % 5 + 1)) for u in range(1, 13) for c in range(1, 9) if (u + c) % 3]
    return spark.createDataFrame(data, "userId int, courseId int, rating double")


def test_recommendations(spark):
    found = recommend.recommend(ratings(spark), 5)
    assert found.schema["recommendations"].dataType.simpleString() == (
        "array<struct<courseId:int,rating:float>>"
    )
    got = found.collect()
    assert sorted(r["userId"] for r in got) == list(range(1, 13))
    for r in got:
        values = [x["rating"] for x in r["recommendations"]]
        assert len(values) == 5 and values == sorted(values, reverse=True)


def test_recommendations_for_keys_beyond_integers_and_some_users(spark):
    far = 3_000_000_000
    rows = [(far + u, far * 2 + i, float((u * i) % 5 + 1)) for u in range(6) for i in range(4)]
    rows += [(None, far, 1.0), (far, None, 1.0)]
    table = spark.createDataFrame(rows, "userId long, courseId long, rating double")
    asked = spark.createDataFrame([(far + 1,), (far + 1,), (far + 4,), (7,)], "userId long")
    everyone = {r["userId"]: r["recommendations"] for r in recommend.recommend(table, 2).collect()}
    some = {r["userId"]: r["recommendations"] for r in recommend.recommend(table, 2, users=asked).collect()}
    assert set(everyone) == {far + u for u in range(6)} and set(some) == {far + 1, far + 4}
    for u, found in some.items():
        assert [x["courseId"] for x in found] == [x["courseId"] for x in everyone[u]]
        assert all(x["courseId"] >= 2 * far for x in found)


def test_dense_ids_follow_the_order_of_the_keys(spark):
    table = spark.range(0, 500).selectExpr("7 * id + 3000000000 AS k").repartition(9)
    rows = recommend.dense_ids(table.union(table), "k", "n").collect()
    assert sorted((r["k"], r["n"]) for r in rows) == [(7 * i + 3_000_000_000, i) for i in range(500)]
    assert recommend.dense_ids(table.limit(0), "k", "n").count() == 0


def test_recommendations_are_the_best_of_the_factors(spark):
    model = recommend.fit_ratings(ratings(spark))
    users = dict(rows(model.userFactors))
    items = dict(rows(model.itemFactors))
    for r in model.recommendForAllUsers(3).collect():
        scores = {c: sum(a * b for a, b in zip(users[r["userId"]], f)) for c, f in items.items()}
        best = sorted(scores.values(), reverse=True)[:3]
        assert [x["rating"] for x in r["recommendations"]] == pytest.approx(best, rel=1e-4)


def test_recommendations_beside_history(spark):
    history = ratings(spark)
    recs = checkpointed(recommend.recommend(history, 2))
    extra = spark.createDataFrame([(99, [(1, 1.0)])], recs.schema)
    found = recommend.with_history(recs.union(extra), history).collect()
    assert len(found) == history.count() + 1
    by_user = {r["userId"]: r["recommendations"] for r in recs.collect()}
    for r in found:
        if r["userId"] == 99:
            assert r["courseId"] is None and len(r["recommendations"]) == 1
        else:
            assert r["recommendations"] == by_user[r["userId"]]
    assert not any(math.isnan(r["rating"]) for r in found if r["rating"] is not None)
