"""Nulls, large values and layouts that the given tables do not hold."""

import datetime as dt

import pytest

from tallyforge.functions.udfs import register
from tallyforge.operators import crosstab, joins, profile, split
from tallyforge.plans import tuning


def test_null_and_unreadable_months_are_null(spark):
    rows = [("W", "2015-03-01 00:00:00"), ("W", None), ("W", "2015-12-01 00:00:00"), ("W", "soon")]
    df = spark.createDataFrame(rows, "level string, datetime string")
    df.createOrReplaceTempView("edge_log")
    expected = {("W", None, 2), ("W", "March", 1), ("W", "December", 1)}
    assert {tuple(r) for r in crosstab.month_counts(df, "level", "datetime").collect()} == expected
    assert {tuple(r) for r in crosstab.month_counts_sql(spark, "edge_log").collect()} == expected
    real = spark.createDataFrame([("W", dt.datetime(2015, 3, 1)), ("W", None)], "level string, datetime timestamp")
    assert {tuple(r) for r in crosstab.month_counts(real, "level", "datetime").collect()} == {("W", "March", 1), ("W", None, 1)}


def test_registered_month_number_of_null(spark):
    register(spark)
    found = spark.sql("SELECT getMonthNumber(m) AS n FROM VALUES ('March'), (NULL) AS t(m)").collect()
    assert {r.n for r in found} == {2, None}


def test_correlation_after_leading_nulls(spark):
    rows = [(None, 1.0)] * 100 + [(1e9 + k, 1e9 + k + (k % 3)) for k in range(50)] + [(1e9, None)]
    df = spark.createDataFrame(rows, "x double, y double").coalesce(1)
    found = {(r.col1, r.col2): r.corr for r in profile.corr_matrix(df).collect()}
    assert found["x", "x"] == pytest.approx(1) and found["x", "y"] == pytest.approx(df.na.drop().corr("x", "y"), abs=1e-6)


def test_null_keys_stay_in_a_part(spark):
    df = spark.createDataFrame([(k if k % 10 else None, k) for k in range(100)], "k int, v int")
    parts = split.key_split(df, "k", 0.3)
    assert sum(p.count() for p in parts) == 100


def test_hold_out_without_key_is_one_mark(spark):
    df = spark.createDataFrame([(float(k), float(3 * k + k % 7)) for k in range(400)], "x double, y double")
    for layout in (df.coalesce(1), df.repartition(5)):
        tuned = tuning.tune_linreg(layout, "y", ["x"], reg=[0.01], elastic=[0.0])
        held = {r.x for r in split.with_mark(df, None, 0.2, 42).where("_held").collect()}
        assert {r.x for r in tuned.predictions.collect()} == held


def test_join_keys_are_checked_at_every_size(spark):
    fact = spark.createDataFrame([(1.5, 1)], "k double, v int")
    with pytest.raises(ValueError):
        joins.lookup_join(fact, fact.select("k"), "k")
    with pytest.raises(ValueError):
        joins.lookup_join(fact.select(fact.v.alias("k")), spark.createDataFrame([("1",)], "k string"), "k")
