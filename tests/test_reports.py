import math

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.columns import MONTHS
from tallyforge.operators import crosstab, popularity as pop, profile, text

from .fixtures import CHAPTERS, TITLES, VIEWS, rows

LOGS = [
    ("WARN", "2015-07-01 10:00:00"), ("WARN", "2016-07-09 10:00:00"), ("INFO", "2015-01-05 10:00:00"),
]


def test_month_counts_in_calendar_order(spark):
    logs = spark.createDataFrame([*LOGS, ("ERROR", "2015-01-05 10:00:00")], "level string, datetime string")
    expected = [("ERROR", "January", 1), ("INFO", "January", 1), ("WARN", "July", 2)]
    assert rows(crosstab.month_counts(logs, "level", "datetime")) == expected
    logs.createOrReplaceTempView("some_logs")
    assert rows(crosstab.month_counts_sql(spark, "some_logs")) == expected


def test_month_pivot_keeps_rows_without_listed_months(spark):
    logs = spark.createDataFrame(LOGS, "level string, datetime string")
    some = crosstab.month_pivot(logs, "level", "datetime", ["January", "February"])
    assert some.columns == ["level", "January", "February"]
    assert sorted(rows(some)) == [("INFO", 1, 0), ("WARN", 0, 0)]
    assert crosstab.month_pivot(logs, "level", "datetime").columns == ["level", *MONTHS]


def test_pivot_stats(spark):
    scores = spark.createDataFrame(
        [("m", "2005", "10"), ("m", "2005", "20"), ("m", "2006", "7"), ("h", "2005", "3")],
        "subject string, year string, score string",
    )
    found = crosstab.pivot_stats(scores, "subject", "year", "score")
    assert found.columns == [
        "subject", "2005_average", "2005_stddev", "2006_average", "2006_stddev"
    ]
    assert sorted(rows(found)) == [("h", 3.0, 0.0, 0.0, 0.0), ("m", 15.0, 7.07, 7.0, 0.0)]
    listed = crosstab.pivot_stats(scores, "subject", "year", "score", ["2006"])
    assert sorted(rows(listed)) == [("h", 0.0, 0.0), ("m", 7.0, 0.0)]


def test_pivot_sum(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 3.0), (2, "b", 1.0)], "u int, i string, v double")
    found = crosstab.pivot_sum(df, "u", "i", "v")
    assert found.columns == ["u", "a", "b"]
    assert sorted(rows(found), key=lambda r: r[0]) == [(1, 5.0, None), (2, None, 1.0)]


def test_top_words(spark):
    df = spark.createDataFrame([("Don't stop, DON'T go",), ("the go-to stop",), (None,)], "value string")
    assert rows(text.top_words(df, "value", n=3)) == [("dont", 2), ("stop", 2), ("go", 1)]
    stop = spark.createDataFrame([("dont",), ("the",)], "word string")
    expected = [("go", 1), ("goto", 1), ("stop", 2)]
    assert sorted(rows(text.word_counts(df, "value", stop))) == expected
    assert sorted(rows(text.word_counts(df, "value", ["dont", "the"]))) == expected


def test_top_words_plan_has_no_full_sort(spark):
    df = spark.createDataFrame([("a b",)], "value string")
    plan = text.top_words(df, "value")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def popularity_tables(spark):
    return (
        spark.createDataFrame(VIEWS, "userId int, chapterId int"),
        spark.createDataFrame(CHAPTERS, "chapterId int, courseId int"),
        spark.createDataFrame(TITLES, "courseId int, title string"),
    )


def test_popularity(spark):
    found = pop.popularity(*popularity_tables(spark))
    titles = dict(TITLES)
    assert rows(found) == [(titles[2], 10), (titles[1], 6), (titles[3], 0)]


def test_popularity_shares(spark):
    views, chapters, _ = popularity_tables(spark)
    assert sorted(rows(pop.course_shares(views, chapters))) == [
        (1, 1, 1, 3), (1, 2, 1, 3), (2, 1, 1, 1), (3, 1, 1, 10)
    ]


def test_popularity_leaves_out_unknown_chapters_and_untitled_courses(spark):
    views, chapters, titles = popularity_tables(spark)
    more = views.union(spark.createDataFrame([(1, 5000)], "userId int, chapterId int"))
    found = pop.popularity(more, chapters, titles.filter("courseId <> 2"))
    assert [r[1] for r in rows(found)] == [6, 0]


def test_key_sizes_and_partitions(spark):
    df = spark.range(0, 100, 1, 4).select((F.col("id") % 3).alias("k"))
    assert sorted(rows(profile.key_sizes(df, "k"))) == [(0, 34), (1, 33), (2, 33)]
    assert rows(profile.key_count(df, "k")) == [(3,)]
    parts = rows(profile.partition_profile(df, "k"))
    assert {p for p, _, _ in parts} == {0, 1, 2, 3}
    assert sum(n for _, _, n in parts) == 100


def test_correlations(spark):
    data = [(1.0, 2.0, 5.0, 1), (2.0, 4.1, 5.0, None), (3.0, 5.9, 5.0, 7), (4.0, 8.2, 5.0, 2)]
    df = spark.createDataFrame(data, "a double, b double, flat double, gaps int")

    def expected(x, y):
        pairs = [(p, q) for p, q in zip(x, y) if p is not None and q is not None]
        mx, my = (sum(v) / len(pairs) for v in zip(*pairs))
        sxy = sum((p - mx) * (q - my) for p, q in pairs)
        sxx, syy = sum((p - mx) ** 2 for p, _ in pairs), sum((q - my) ** 2 for _, q in pairs)
        return sxy / math.sqrt(sxx * syy) if sxx * syy > 0 else None

    columns = dict(zip(df.columns, zip(*data)))
    found = {(a, b): r for a, b, r in rows(profile.corr_matrix(df))}
    assert len(found) == 16
    for (a, b), r in found.items():
        assert r == (None if expected(columns[a], columns[b]) is None else
                     pytest.approx(expected(columns[a], columns[b]), abs=1e-12))
    target = {b: r for _, b, r in rows(profile.corr_target(df, "a"))}
    assert target == {b: found[("a", b)] for b in df.columns}


def test_correlations_of_shifted_values_stay_exact(spark):
    df = spark.range(1000).select(
        (F.col("id") + 1e9).alias("x"), (F.lit(1e9) - F.col("id")).alias("y")
    )
    assert rows(profile.corr_target(df, "x", ["y"]))[0][2] == pytest.approx(-1.0, abs=1e-12)


def test_correlation_with_a_constant_column_is_null(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("x"), F.col("id").alias("y"))
    assert rows(profile.corr_target(df, "x", ["x", "y"])) == [("x", "x", None), ("x", "y", None)]


def test_correlation_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert rows(profile.corr_target(df, "a", ["b"])) == [("a", "b", None)]


def test_summary_stats(spark):
    df = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "n int, t string")
    name, count, mean, deviation, low, high = rows(profile.summary_stats(df))[0]
    assert (name, count, mean, low, high) == ("n", 2, 2.0, 1.0, 3.0)
    assert deviation == pytest.approx(2**0.5)
