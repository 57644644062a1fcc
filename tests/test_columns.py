import pytest
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.functions.udfs import register

from .fixtures import rows


def one(spark, value, kind, expr):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr).first()[0]


@pytest.mark.parametrize("name,number", [("January", 0), ("July", 6), ("December", 11)])
def test_month_number_counts_from_zero(spark, name, number):
    assert one(spark, name, "string", C.month_number("x")) == number
    assert one(spark, name, "string", C.try_month_number("x")) == number


def test_bad_month_name(spark):
    with pytest.raises(Exception):
        one(spark, "Smarch", "string", C.month_number("x"))
    assert one(spark, "Smarch", "string", C.try_month_number("x")) is None


def test_month_names_round_trip(spark):
    df = spark.range(1, 13).select(C.name_of_month("id").alias("m"))
    assert [r[0] for r in rows(df)] == list(C.MONTHS)
    assert [r[0] for r in rows(df.select(C.month_number("m")))] == list(range(12))


@pytest.mark.parametrize(
    "share,score",
    [(90.1, 10), (90.0, 4), (50.1, 4), (50.0, 2), (25.1, 2), (25.0, 0), (0.0, 0)],
)
def test_bucket_bounds_are_exclusive(spark, share, score):
    assert one(spark, share, "double", C.bucket_score("x")) == score


@pytest.mark.parametrize(
    "country,group",
    [("GB", "GB"), ("UNKNOWN", "UNKNOWN"), ("DE", "EUROPE"), ("EL", "EUROPE"), ("GR", "OTHER"),
     ("BR", "OTHER"), (None, "OTHER")],
)
def test_country_groups(spark, country, group):
    assert one(spark, country, "string", C.country_group("x")) == group


@pytest.mark.parametrize("views,label", [(None, 1), (0, 1), (3, 0)])
def test_not_above(spark, views, label):
    assert one(spark, views, "int", C.not_above("x")) == label


@pytest.mark.parametrize("payments,label", [(None, 0), (0, 0), (1, 1), (5, 1)])
def test_at_least(spark, payments, label):
    assert one(spark, payments, "int", C.at_least("x", 1)) == label


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert rows(df.select(C.ratio("a", "b"))) == [(None,), (0.25,)]
    assert rows(df.select(C.percentage("a", "b"))) == [(None,), (25.0,)]


def test_fill_numeric_leaves_text(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), None), (1, 2.0, "x")], "a int, b double, c string"
    )
    assert rows(C.fill_numeric(df)) == [(0, 0.0, None), (1, 2.0, "x")]


def test_zero_nulls_only_in_named_columns(spark):
    df = spark.createDataFrame([(None, None)], "a int, b int")
    assert rows(C.zero_nulls(df, ["a"])) == [(0, None)]


def test_words(spark):
    text = "Don't  stop 42\tnow "
    assert [w for w in one(spark, text, "string", C.words_of("x")) if w] == ["dont", "stop", "now"]


def test_fields_and_binary(spark):
    assert one(spark, "WARN,2016-12-31", "string", C.field("x", 2)) == "2016-12-31"
    assert one(spark, bytearray(b"Git"), "binary", C.text_of("x")) == "Git"


def test_text_columns_become_typed(spark):
    df = spark.createDataFrame([("2015-03-04 05:06:07", "1.5"), ("soon", "much")], "t string, n string")
    got = rows(df.select(F.month(C.as_timestamp(df, "t")), C.as_double(df, "n")))
    assert got == [(3, 1.5), (None, None)]


def test_registered_functions_work_in_sql(spark):
    register(spark)
    df = spark.createDataFrame([("July", "FR"), ("March", "IN"), ("May", None)], "m string, c string")
    df.createOrReplaceTempView("udf_rows")
    got = rows(spark.sql("SELECT m, countryGrouping(c) FROM udf_rows ORDER BY getMonthNumber(m)"))
    assert got == [("March", "IN"), ("May", "OTHER"), ("July", "EUROPE")]
