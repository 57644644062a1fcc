"""Exact quantiles against sorting."""

import math
import random

import pytest

from tallyforge.operators import profile


def brute(values, q):
    own = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    return own[max(1, math.ceil(round(q * len(own), 9))) - 1] if own else None


AT = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


@pytest.mark.parametrize("k", [8, 200])
def test_like_sorting(spark, k):
    """Even, skewed, tied and mostly null columns; a coarse sketch too."""
    r = random.Random(k)
    rows = [
        (r.randrange(10**6), r.lognormvariate(0, 4), r.choice([1.5, 2.5]) if r.random() < 0.9 else -3.0, r.random() if r.random() < 0.01 else None, None, i % 3)
        for i in range(5000)
    ]
    df = spark.createDataFrame(rows, "a long, b double, c double, d double, e double, f int").repartition(5)
    got = {(x["column"], x["quantile"]): x["value"] for x in profile.quantiles(df, at=AT, k=k).collect()}
    assert got == {(c, q): brute([row[i] for row in rows], q) for i, c in enumerate("abcdef") for q in AT}


def test_a_missed_bracket_is_counted_whole(spark, monkeypatch):
    """Brackets that hold nothing: the counts show it, and the column is counted anew."""
    plain, calls = profile._exact, []

    def exact(values, asked):
        calls.append(len(asked))
        return plain(values, asked if len(calls) > 1 else [(*x[:4], 1e9, 2e9) for x in asked])

    monkeypatch.setattr(profile, "_exact", exact)
    df = spark.range(1000).selectExpr("id AS a", "-id AS b")
    got = [tuple(x) for x in profile.quantiles(df, at=(0.5,)).collect()]
    assert got == [("a", 0.5, 499.0), ("b", 0.5, -500.0)] and calls == [2, 2]


def test_empty_odd_and_wrong(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (1.0, None)], "x double, y int")
    got = {(x["column"], x["quantile"]): x["value"] for x in profile.quantiles(df, at=(0.3, 0.6, 1.0)).collect()}
    assert got["x", 0.3] == 1.0 and got["x", 0.6] == float("inf") and math.isnan(got["x", 1.0]) and got["y", 1.0] == 2.0
    assert [tuple(x) for x in profile.quantiles(df.limit(0), ["y"], at=(0.5,)).collect()] == [("y", 0.5, None)]
    assert profile.quantiles(df, []).count() == 0
    with pytest.raises(ValueError):
        profile.quantiles(df, at=(2,))
