"""Cross-tabs, expressions, words, popularity and profiles over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C, udfs
from ..operators import crosstab, popularity as pop, profile, text
from ..operators.joins import lookup_join
from ..sources.tables import literal_table, read_table, register_view
from .base import query

_MONTHS = C.MONTHS


# --- cross-tabs -------------------------------------------------------------------

_MONTH_COUNTS_SQL = """
    SELECT o_orderpriority AS level, strftime(o_orderdate, '%B') AS month, count(*) AS total
    FROM orders GROUP BY ALL
"""


@query("level_month_counts", _MONTH_COUNTS_SQL)
def level_month_counts(spark, sf):
    return crosstab.month_counts(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderdate")


@query("level_month_sql", _MONTH_COUNTS_SQL)
def level_month_sql(spark, sf):
    logs = read_table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("level"), F.col("o_orderdate").alias("datetime")
    )
    register_view(logs, "logs_by_month")
    return crosstab.month_counts_sql(spark, "logs_by_month")


@query("level_month_udf", _MONTH_COUNTS_SQL)
def level_month_udf(spark, sf):
    """The same report, put in calendar order by the function registered for SQL."""
    udfs.register(spark)
    counts = crosstab.month_counts(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderdate")
    register_view(counts, "level_months")
    return spark.sql("SELECT * FROM level_months ORDER BY getMonthNumber(month), level")


@query(
    "month_numbers",
    "SELECT o_orderkey, strftime(o_orderdate, '%B') AS month_name, "
    "CAST(month(o_orderdate) - 1 AS INTEGER) AS month_number FROM orders",
)
def month_numbers(spark, sf):
    named = read_table(spark, sf, "orders").select(
        "o_orderkey", C.month_name("o_orderdate").alias("month_name")
    )
    return named.withColumn("month_number", C.month_number("month_name"))


@query(
    "pivot_month_counts",
    "SELECT o_orderpriority, "
    + ", ".join(
        f"count(*) FILTER (strftime(o_orderdate, '%B') = '{m}') AS \"{m}\"" for m in _MONTHS
    )
    + " FROM orders GROUP BY o_orderpriority",
)
def pivot_month_counts(spark, sf):
    return crosstab.month_pivot(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderdate")


_YEARS = range(1995, 2002)


def _year_stats_sql(years):
    parts = []
    for y in years:
        here = f"FILTER (year(o_orderdate) = {y})"
        parts.append(f'coalesce(round(avg(o_totalprice) {here}, 2), 0) AS "{y}_average"')
        parts.append(f'coalesce(round(stddev_samp(o_totalprice) {here}, 2), 0) AS "{y}_stddev"')
    return f"SELECT o_orderpriority, {', '.join(parts)} FROM orders GROUP BY o_orderpriority"


def _orders_by_year(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderpriority", F.year("o_orderdate").alias("year"), "o_totalprice"
    )


@query("pivot_year_stats", _year_stats_sql(_YEARS))
def pivot_year_stats(spark, sf):
    return crosstab.pivot_stats(_orders_by_year(spark, sf), "o_orderpriority", "year", "o_totalprice")


@query("pivot_year_stats_listed", _year_stats_sql((2000, 1996)))
def pivot_year_stats_listed(spark, sf):
    return crosstab.pivot_stats(
        _orders_by_year(spark, sf), "o_orderpriority", "year", "o_totalprice", values=[2000, 1996]
    )


# Columns that tell lines of one part or supplier apart.
_LINE = ("l_orderkey", "l_linenumber", "l_shipdate")

_BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query(
    "user_item_pivot",
    "SELECT l_suppkey, "
    + ", ".join(f"sum(l_quantity) FILTER (p_brand = '{b}') AS \"{b}\"" for b in _BRANDS)
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey",
)
def user_item_pivot(spark, sf):
    lines = read_table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    brands = read_table(spark, sf, "part").select("p_partkey", "p_brand")
    joined = lookup_join(lines, brands, "p_partkey", spread=_LINE)
    return crosstab.pivot_sum(joined, "l_suppkey", "p_brand", "l_quantity")


# --- projections and predicates ---------------------------------------------------


@query(
    "filter_select_limit",
    "SELECT o_orderkey, o_totalprice, 'open' AS state FROM orders "
    "WHERE o_orderstatus = 'O' AND o_totalprice >= 100000 "
    "ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def filter_select_limit(spark, sf):
    return (
        read_table(spark, sf, "orders")
        .filter((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") >= 100000))
        .select("o_orderkey", "o_totalprice", F.lit("open").alias("state"))
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(100)
    )


@query(
    "ratio_column",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    "l_extendedprice / nullif(l_quantity, 0) AS unit_price, "
    "l_discount * 100 AS discount_percent FROM lineitem",
)
def ratio_column(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        C.ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        C.scaled("l_discount", 100).alias("discount_percent"),
    )


# The code each nation key stands for here.
_NATION_CODES = (
    "GB", "US", "IN", "UNKNOWN", "BE", "BG", "CZ", "DK", "DE", "EE", "IE", "EL", "GR",
    "ES", "FR", "HR", "BR", "CN", "JP", "CH", "IS", "NO", "LI", "EU", "ZA",
)


def _sql_list(values):
    return ", ".join(f"'{v}'" for v in values)


_COUNTRY_SQL = f"list_extract([{_sql_list(_NATION_CODES)}], c_nationkey + 1)"


def _nation_code(column):
    codes = F.array(*[F.lit(c) for c in _NATION_CODES])
    return F.when(F.col(column).isNotNull(), F.element_at(codes, F.col(column) + 1))


_REGROUP_SQL = f"""
    WITH coded AS (SELECT c_custkey, {_COUNTRY_SQL} AS country FROM customer)
    SELECT c_custkey, country,
           CASE WHEN country IN ({_sql_list(C.KEPT_COUNTRIES)}) THEN country
                WHEN country IN ({_sql_list(C.EUROPEAN_COUNTRIES)}) THEN 'EUROPE'
                ELSE 'OTHER' END AS country_group
    FROM coded
    """


@query("category_regroup", _REGROUP_SQL)
def category_regroup(spark, sf):
    coded = read_table(spark, sf, "customer").select(
        "c_custkey", _nation_code("c_nationkey").alias("country")
    )
    return coded.withColumn("country_group", C.country_group("country"))


@query("category_regroup_udf", _REGROUP_SQL)
def category_regroup_udf(spark, sf):
    """The same groups by the function registered for SQL."""
    udfs.register(spark)
    coded = read_table(spark, sf, "customer").select("c_custkey", _nation_code("c_nationkey").alias("country"))
    register_view(coded, "coded_customers")
    return spark.sql("SELECT c_custkey, country, countryGrouping(country) AS country_group FROM coded_customers")


@query(
    "literal_lookup",
    """
    SELECT o_orderkey, o_orderpriority, w.weight
    FROM orders JOIN (VALUES ('1-URGENT', 10), ('2-HIGH', 4), ('3-MEDIUM', 2)) w(level, weight)
      ON o_orderpriority = w.level
    """,
)
def literal_lookup(spark, sf):
    weights = literal_table(
        spark, [("1-URGENT", 10), ("2-HIGH", 4), ("3-MEDIUM", 2)], "o_orderpriority string, weight int"
    )
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return lookup_join(orders, weights, "o_orderpriority").select(
        "o_orderkey", "o_orderpriority", "weight"
    )


# --- words ------------------------------------------------------------------------

_WORDS_SQL = """
    words AS (
        SELECT unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z ]', '', 'g')), ' ')) AS word
        FROM documents
    ),
    counted AS (SELECT word, count(*) AS count FROM words WHERE word <> '' GROUP BY word)
"""

# Stop words of the report.
_STOP = ("the", "of", "and", "in", "that", "to", "is")


@query("word_counts", f"WITH {_WORDS_SQL} SELECT word, count FROM counted")
def word_counts(spark, sf):
    return text.word_counts(read_table(spark, sf, "documents"), "text")


@query(
    "top_words",
    f"WITH {_WORDS_SQL} SELECT word, count FROM counted WHERE word NOT IN ({_sql_list(_STOP)}) "
    "ORDER BY count DESC, word LIMIT 10",
)
def top_words(spark, sf):
    return text.top_words(read_table(spark, sf, "documents"), "text", _STOP)


@query(
    "top_words_threshold",
    f"WITH {_WORDS_SQL} SELECT word, count FROM counted WHERE word NOT IN ({_sql_list(_STOP)}) "
    "ORDER BY count DESC, word LIMIT 25",
)
def top_words_threshold(spark, sf):
    """The most frequent words, counting only candidates over all tasks."""
    return text.top_words_threshold(read_table(spark, sf, "documents"), "text", _STOP, 25)


# --- popularity -------------------------------------------------------------------

_POPULARITY_SQL = """
    seen AS (
        SELECT DISTINCT s_nationkey AS userId, l_partkey AS chapterId
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    ),
    watched AS (
        SELECT userId, p_brand AS courseId, count(*) AS watched
        FROM seen JOIN part ON chapterId = p_partkey GROUP BY ALL
    ),
    totals AS (SELECT p_brand AS courseId, count(*) AS total FROM part GROUP BY ALL),
    shares AS (
        SELECT userId, courseId, watched, total, 100.0 * watched / total AS share
        FROM watched JOIN totals USING (courseId)
    ),
    scored AS (
        SELECT *, CASE WHEN share > 90 THEN 10 WHEN share > 50 THEN 4
                       WHEN share > 25 THEN 2 ELSE 0 END AS score
        FROM shares
    )
"""


def _views(spark, sf):
    """A supplier's nation views the parts it ships."""
    lines = read_table(spark, sf, "lineitem").withColumnsRenamed(
        {"l_suppkey": "s_suppkey", "l_partkey": "chapterId"}
    )
    nations = read_table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("userId"))
    return lookup_join(lines, nations, "s_suppkey", spread=_LINE).select("userId", "chapterId")


def _chapters(spark, sf):
    return read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("chapterId"), F.col("p_brand").alias("courseId")
    )


@query(
    "distinct_views",
    f"WITH {_POPULARITY_SQL} SELECT userId, chapterId FROM seen",
)
def distinct_views(spark, sf):
    return _views(spark, sf).distinct()


@query(
    "watched_per_user",
    f"WITH {_POPULARITY_SQL} SELECT userId, courseId, watched FROM watched",
)
def watched_per_user(spark, sf):
    return pop.watched_per_user(_views(spark, sf), _chapters(spark, sf))


@query(
    "bucket_scores",
    f"""
    WITH {_POPULARITY_SQL}
    SELECT courseId, watched, count(*) AS users, total, round(any_value(share), 6) AS share,
           CAST(any_value(score) AS INTEGER) AS score
    FROM scored GROUP BY courseId, watched, total
    """,
)
def bucket_scores(spark, sf):
    share = C.percentage("watched", "total")
    return pop.course_shares(_views(spark, sf), _chapters(spark, sf)).select(
        "courseId", "watched", "users", "total",
        F.round(share, 6).alias("share"), C.bucket_score(share).alias("score"),
    )


@query(
    "course_popularity",
    f"WITH {_POPULARITY_SQL} SELECT courseId AS title, CAST(sum(score) AS BIGINT) AS score "
    "FROM scored GROUP BY courseId",
)
def course_popularity(spark, sf):
    chapters = _chapters(spark, sf)
    titles = chapters.select("courseId").distinct().withColumn("title", F.col("courseId"))
    return pop.popularity(_views(spark, sf), chapters, titles)


# --- profiles ---------------------------------------------------------------------


@query("key_sizes", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def key_sizes(spark, sf):
    return profile.key_sizes(read_table(spark, sf, "events"), "event_type")


@query("key_count_bitmaps", "SELECT count(DISTINCT l_orderkey) AS keys FROM lineitem")
def key_count_bitmaps(spark, sf):
    """The number of orders, a bit each."""
    return profile.integer_key_count(read_table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "pivot_sparse",
    """
    WITH names AS (
        SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS rank FROM lineitem GROUP BY l_partkey
    ), sums AS (SELECT l_suppkey, l_partkey, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, (SELECT count(*) FROM names) AS size, string_agg(rank || ':' || total, ' ' ORDER BY rank) AS entries
    FROM sums JOIN names USING (l_partkey) GROUP BY l_suppkey
    """,
)
def pivot_sparse(spark, sf):
    """Lines by supplier and part, one sparse vector per supplier."""
    lines = read_table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", F.col("l_linenumber").cast("bigint").alias("n"))
    vectors, _ = crosstab.pivot_sparse(lines, "l_suppkey", "l_partkey", "n")
    pairs = F.transform(F.arrays_zip("indices", "values"), lambda x: F.concat_ws(":", x["indices"], x["values"]))
    return vectors.select("l_suppkey", "size", F.array_join(pairs, " ").alias("entries"))


@query("key_count", "SELECT count(DISTINCT user_id) AS keys FROM events")
def key_count(spark, sf):
    return profile.key_count(read_table(spark, sf, "events"), "user_id")


@query(
    "partition_profile",
    "SELECT event_type, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY event_type",
)
def partition_profile(spark, sf):
    """Rows per key summed over the partitions, since the partitions themselves depend on
    the cluster."""
    parts = profile.partition_profile(read_table(spark, sf, "events"), "event_type")
    return parts.groupBy("event_type").agg(F.sum("rows").alias("rows"))


@query(
    "partition_counts",
    "SELECT 'dealt' AS step, CAST(7 AS BIGINT) AS partitions, count(*) AS rows FROM events "
    "UNION ALL SELECT 'merged', 3, count(*) FROM events",
)
def partition_counts(spark, sf):
    """Partitions of the events dealt out in turn, and after merging neighbours."""
    dealt = read_table(spark, sf, "events").select("event_type").repartition(7)
    return profile.partition_counts({"dealt": dealt, "merged": dealt.coalesce(3)})


_NUMERIC = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _corr_sql(a, b):
    return f"SELECT '{a}' AS col1, '{b}' AS col2, round(corr({a}, {b}), 6) AS corr FROM lineitem"


@query("corr_target", " UNION ALL ".join(_corr_sql("l_extendedprice", c) for c in _NUMERIC))
def corr_target(spark, sf):
    found = profile.corr_target(read_table(spark, sf, "lineitem"), "l_extendedprice", _NUMERIC)
    return found.withColumn("corr", F.round("corr", 6))


@query("corr_matrix", " UNION ALL ".join(_corr_sql(a, b) for a in _NUMERIC for b in _NUMERIC))
def corr_matrix(spark, sf):
    found = profile.corr_matrix(read_table(spark, sf, "lineitem"), _NUMERIC)
    return found.withColumn("corr", F.round("corr", 6))


@query("corr_wide", " UNION ALL ".join(_corr_sql(a, b) for a in _NUMERIC for b in _NUMERIC))
def corr_wide(spark, sf):
    """The same matrix from products of blocks of rows, for tables of hundreds of columns."""
    found = profile.corr_wide(read_table(spark, sf, "lineitem"), _NUMERIC)
    return found.withColumn("corr", F.round("corr", 6))


@query(
    "quartiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {q}::DOUBLE AS quantile, CAST(quantile_disc({c}, {q}) AS DOUBLE) AS value FROM lineitem"
        for c in _NUMERIC for q in (0.25, 0.5, 0.75)
    ),
)
def quartiles(spark, sf):
    """The quartiles of the summary, exact."""
    return profile.quantiles(read_table(spark, sf, "lineitem"), _NUMERIC)


@query(
    "summary_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
        for c in _NUMERIC
    ),
)
def summary_stats(spark, sf):
    stats = profile.summary_stats(read_table(spark, sf, "lineitem"), _NUMERIC)
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})
