"""Feature preparation, models and their metrics over the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import features as feat, metrics, split
from ..operators.inner_products import best_products
from ..operators.joins import lookup_join
from ..plans import classification, clusters, elastic_path, recommend, regression, shared_clusters, trees, tuning, viewing
from ..plans.trials import trial_rows
from ..session import checkpointed
from ..sources.tables import read_table
from .base import query

# --- preparation ------------------------------------------------------------------

_CUT = "1999-01-01"
_LAST = "1998-01-01"
_NEXT = "2000-01-01"

_ACTIVITY_SQL = f"""
    activity AS (
        SELECT o_custkey,
               CAST(min(year(o_orderdate)) FILTER (o_orderdate < '{_CUT}') AS INTEGER) AS firstSub,
               CAST(sum(CASE WHEN o_orderdate < '{_CUT}' THEN 1 END) AS BIGINT) AS all_time_views,
               CAST(sum(CASE WHEN o_orderdate >= '{_LAST}' AND o_orderdate < '{_CUT}' THEN 1 END)
                    AS BIGINT) AS last_month_views,
               CAST(sum(CASE WHEN o_orderdate >= '{_CUT}' AND o_orderdate < '{_NEXT}' THEN 1 END)
                    AS BIGINT) AS next_month_views
        FROM orders GROUP BY o_custkey
    ),
    customers AS (
        SELECT c_custkey, c_acctbal < 0 AS is_cancelled, c_mktsegment AS payment_method_type,
               firstSub, all_time_views, last_month_views, next_month_views
        FROM customer LEFT JOIN activity ON c_custkey = o_custkey
    )
"""


def _customers(spark, sf):
    """Customers with their orders before, in the year before, and in the year after a day.
    Orders are counted per customer before they are joined."""
    day = F.col("o_orderdate")
    past = day < F.lit(_CUT).cast("timestamp_ntz")
    last = past & (day >= F.lit(_LAST).cast("timestamp_ntz"))
    coming = ~past & (day < F.lit(_NEXT).cast("timestamp_ntz"))
    activity = (
        read_table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min(F.when(past, F.year(day))).alias("firstSub"),
            F.sum(F.when(past, 1)).alias("all_time_views"),
            F.sum(F.when(last, 1)).alias("last_month_views"),
            F.sum(F.when(coming, 1)).alias("next_month_views"),
        )
    )
    customers = read_table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") < 0).alias("is_cancelled"),
        F.lit(_CUT).alias("observation_date"),
        F.col("c_acctbal").alias("age"),
        F.col("c_mktsegment").alias("payment_method_type"),
        F.col("c_nationkey").alias("country"),
        (F.col("c_nationkey") % 3 + 1).alias("rebill_period_in_months"),
    )
    return customers.join(activity, "c_custkey", "left")


@query(
    "null_label_prep",
    f"""
    WITH {_ACTIVITY_SQL}
    SELECT c_custkey, payment_method_type, coalesce(firstSub, 0) AS firstSub,
           coalesce(all_time_views, 0) AS all_time_views,
           coalesce(last_month_views, 0) AS last_month_views,
           CASE WHEN next_month_views > 0 THEN 0 ELSE 1 END AS label,
           CASE WHEN all_time_views >= 5 THEN 1 ELSE 0 END AS regular
    FROM customers WHERE is_cancelled = false
    """,
)
def null_label_prep(spark, sf):
    return viewing.prepare_churn(_customers(spark, sf)).select(
        "c_custkey", "payment_method_type", "firstSub", "all_time_views", "last_month_views",
        F.col("next_month_views").alias("label"), C.at_least("all_time_views", 5).alias("regular"),
    )


@query(
    "views_prep",
    f"""
    WITH {_ACTIVITY_SQL}
    SELECT c_custkey, payment_method_type, coalesce(firstSub, 0) AS firstSub,
           coalesce(all_time_views, 0) AS all_time_views,
           coalesce(last_month_views, 0) AS last_month_views,
           coalesce(next_month_views, 0) AS label
    FROM customers WHERE is_cancelled = false
    """,
)
def views_prep(spark, sf):
    return viewing.prepare_views(_customers(spark, sf)).select(
        "c_custkey", "payment_method_type", "firstSub", "all_time_views", "last_month_views",
        F.col("next_month_views").alias("label"),
    )


@query(
    "numeric_fill",
    f"""
    WITH {_ACTIVITY_SQL}
    SELECT c_custkey, is_cancelled, nullif(payment_method_type, 'BUILDING') AS payment_method_type,
           coalesce(firstSub, 0) AS firstSub, coalesce(all_time_views, 0) AS all_time_views,
           coalesce(last_month_views, 0) AS last_month_views,
           coalesce(next_month_views, 0) AS next_month_views
    FROM customers
    """,
)
def numeric_fill(spark, sf):
    """Nulls of numeric columns become 0, those of a text column stay."""
    customers = _customers(spark, sf).select(
        "c_custkey", "is_cancelled",
        F.nullif("payment_method_type", F.lit("BUILDING")).alias("payment_method_type"),
        "firstSub", "all_time_views", "last_month_views", "next_month_views",
    )
    return C.fill_numeric(customers)


_PRIORITY_INDEX_SQL = """
    ranked AS (
        SELECT o_orderpriority,
               CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE)
                   AS o_orderpriority_index
        FROM orders GROUP BY o_orderpriority
    )
"""


@query(
    "string_index",
    f"WITH {_PRIORITY_INDEX_SQL} SELECT o_orderkey, o_orderpriority, o_orderpriority_index "
    "FROM orders JOIN ranked USING (o_orderpriority)",
)
def string_index(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return feat.string_index(orders, ["o_orderpriority"])


@query(
    "rank_index",
    """
    WITH ranked AS (
        SELECT o_custkey, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS DOUBLE) AS customer_index
        FROM orders GROUP BY o_custkey
    )
    SELECT o_orderkey, o_custkey, customer_index FROM orders JOIN ranked USING (o_custkey)
    """,
)
def rank_index(spark, sf):
    """Numbers for a column of many values, none of them on the driver."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return feat.rank_indexed(orders, "o_custkey", "customer_index")


@query(
    "index_to_string",
    f"WITH {_PRIORITY_INDEX_SQL} "
    "SELECT o_orderpriority_index, o_orderpriority AS priority FROM ranked",
)
def index_to_string(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderpriority")
    indexed = feat.string_index(orders, ["o_orderpriority"])
    return feat.index_labels(indexed, "o_orderpriority_index", "priority")


_ONE_HOT_SQL = ", ".join(
    f"CASE WHEN o_orderpriority_index = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS priority_{i}"
    for i in range(4)
)


@query(
    "one_hot",
    f"WITH {_PRIORITY_INDEX_SQL} SELECT o_orderkey, {_ONE_HOT_SQL} "
    "FROM orders JOIN ranked USING (o_orderpriority)",
)
def one_hot(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    names = [f"priority_{i}" for i in range(4)]
    encoded = feat.one_hot(orders, ["o_orderpriority"])
    return feat.vector_columns(encoded, "o_orderpriority_vector", names).select("o_orderkey", *names)


@query(
    "feature_vector",
    f"WITH {_PRIORITY_INDEX_SQL} SELECT o_orderkey, o_totalprice AS price, "
    f"CAST(year(o_orderdate) AS DOUBLE) AS year, {_ONE_HOT_SQL} "
    "FROM orders JOIN ranked USING (o_orderpriority)",
)
def feature_vector(spark, sf):
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    names = ["price", "year", *[f"priority_{i}" for i in range(4)]]
    data = feat.with_features(orders, ["o_totalprice", "order_year"], ["o_orderpriority"])
    return feat.vector_columns(data, "features", names).select("o_orderkey", *names)


@query(
    "split_sizes",
    """
    WITH placed AS (
        SELECT o_orderkey,
               CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '/7'), 1, 8) AS BIGINT)
                   < CAST(floor(0.2 * 4294967296) AS BIGINT) AS held
        FROM orders
    )
    SELECT CASE WHEN held THEN 'holdout' ELSE 'train' END AS part, count(*) AS rows,
           CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM placed GROUP BY ALL
    """,
)
def split_sizes(spark, sf):
    marked = split.with_mark(read_table(spark, sf, "orders"), "o_orderkey", 0.2, seed=7)
    return marked.groupBy(F.when(F.col("_held"), "holdout").otherwise("train").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("key_sum")
    )


# --- regression -------------------------------------------------------------------


def _price_fit(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return regression.linreg(lines, "l_extendedprice", ["l_quantity"])


@query(
    "linreg_fit",
    "SELECT round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, "
    "round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, "
    "round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem",
)
def linreg_fit(spark, sf):
    fit = _price_fit(spark, sf)
    return fit.coefficients.select(
        F.round("intercept", 3).alias("intercept"),
        F.round(F.col("coefficients")[0], 4).alias("slope"),
        F.round(F.lit(fit.model.summary.r2), 6).alias("r2"),
    )


_FIT_SQL = """
    fit AS (
        SELECT regr_intercept(l_extendedprice, l_quantity) AS a,
               regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem
    )
"""


@query(
    "linreg_predict",
    f"WITH {_FIT_SQL} SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice AS label, "
    "round(a + b * l_quantity, 3) AS prediction FROM lineitem, fit",
)
def linreg_predict(spark, sf):
    return _price_fit(spark, sf).predictions.select(
        "l_orderkey", "l_linenumber", "l_quantity", "label",
        F.round("prediction", 3).alias("prediction"),
    )


@query(
    "regression_metrics",
    f"""
    WITH {_FIT_SQL}, scored AS (
        SELECT l_returnflag, l_extendedprice AS y, a + b * l_quantity AS p FROM lineitem, fit
    )
    SELECT l_returnflag, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse,
           round(1 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2
    FROM scored GROUP BY l_returnflag
    """,
)
def regression_metrics(spark, sf):
    lines = read_table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    scored = regression.linreg(lines, "l_extendedprice", ["l_quantity"]).predictions
    by_flag = metrics.regression_metrics(scored, by=["l_returnflag"])
    return by_flag.withColumns({"rmse": F.round("rmse", 4), "r2": F.round("r2", 6)})


def _lines(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice"
    )
    return lines.withColumn("tax_share", C.ratio("l_tax", "l_quantity"))


_LINE_NUMERIC = ("l_quantity", "l_discount", "tax_share")


# Least squares with an elastic net has a closed form for a single feature: with r the
# correlation and s the label's deviation, the standardised slope is r, drawn towards zero
# by elastic * reg / s, divided by 1 + (1 - elastic) * reg / s.
_NET_SQL = """
    slope_of AS (
        SELECT *, (sy / sx) * sign(r) * greatest(abs(r) - elastic * reg / sy, 0)
                  / (1 + (1 - elastic) * reg / sy) AS b
        FROM moments
    )
"""


def _net_quantities(spark, sf):
    """Quantity by discounted quantity."""
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity"),
        (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("net_quantity"),
    )


@query(
    "linreg_grid_fits",
    f"""
    WITH points AS (SELECT l_quantity AS y, l_quantity * (1 - l_discount) AS x FROM lineitem),
    moments AS (
        SELECT reg, elastic, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy,
               corr(x, y) AS r
        FROM points, (VALUES (0.01::DOUBLE), (0.1), (0.5)) g(reg), (VALUES (0.0::DOUBLE), (0.5), (1.0)) e(elastic)
        GROUP BY reg, elastic
    ),
    {_NET_SQL}
    SELECT reg AS reg_param, elastic AS elastic_net_param, round(my - b * mx, 4) AS intercept,
           round(b, 4) AS slope
    FROM slope_of
    """,
)
def linreg_grid_fits(spark, sf):
    fits = regression.linreg_grid(
        _net_quantities(spark, sf), "l_quantity", ["net_quantity"], tolerance=1e-10
    )
    return fits.select(
        "reg_param", "elastic_net_param", F.round("intercept", 4).alias("intercept"),
        F.round(F.col("coefficients")[0], 4).alias("slope"),
    )


@query(
    "elastic_grid_fits",
    f"""
    WITH points AS (SELECT l_quantity AS y, l_quantity * (1 - l_discount) AS x, l_orderkey % 3 AS part FROM lineitem),
    moments AS (
        SELECT fold, reg, elastic, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS r
        FROM points, (VALUES (0), (1), (2)) f(fold), (VALUES (0.01::DOUBLE), (0.1), (0.5)) g(reg), (VALUES (0.0::DOUBLE), (0.5), (1.0)) e(elastic)
        WHERE part <> fold GROUP BY fold, reg, elastic
    ),
    {_NET_SQL}
    SELECT fold::BIGINT AS fold, reg AS reg_param, elastic AS elastic_net_param, round(my - b * mx, 4) AS intercept, round(b, 4) AS slope,
        round(sqrt(avg((y - (my - b * mx) - b * x) ** 2)), 4) AS rmse
    FROM slope_of JOIN points ON part = fold GROUP BY fold, reg, elastic, my, mx, b
    """,
)
def elastic_grid_fits(spark, sf):
    """Every point of the grid for every fold, from one scan."""
    lines = _net_quantities(spark, sf).withColumn("fold", F.col("l_orderkey") % 3)
    fits = elastic_path.elastic_grid(lines, "l_quantity", ["net_quantity"], fold="fold")
    return fits.select(
        "fold", "reg_param", "elastic_net_param", F.round("intercept", 4).alias("intercept"),
        F.round(F.col("coefficients")[0], 4).alias("slope"), F.round("rmse", 4).alias("rmse"),
    )


_HOLDOUT_SQL = f"""
    WITH points AS (
        SELECT l_quantity AS y, l_quantity * (1 - l_discount) AS x,
               CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '/42'), 1, 8) AS BIGINT)
                   < CAST(floor(0.2 * 4294967296) AS BIGINT) AS held
        FROM lineitem
    ),
    moments AS (
        SELECT 0.1::DOUBLE AS reg, 0.0::DOUBLE AS elastic, avg(x) AS mx, avg(y) AS my,
               stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS r
        FROM points WHERE NOT held
    ),
    {_NET_SQL},
    scored AS (SELECT held, y, my + b * (x - mx) AS p FROM points, slope_of),
    quality AS (
        SELECT held, sqrt(avg((p - y) * (p - y))) AS rmse,
               1 - avg((p - y) * (p - y)) / var_pop(y) AS r2
        FROM scored GROUP BY held
    )
    SELECT round(my - b * mx, 5) AS intercept, round(b, 5) AS slope,
           round(t.rmse, 5) AS rmse_train, round(t.r2, 6) AS r2_train,
           round(h.rmse, 5) AS rmse_holdout, round(h.r2, 6) AS r2_holdout,
           reg AS reg_param, elastic AS elastic_net_param
    FROM slope_of, quality t, quality h WHERE NOT t.held AND h.held
"""


@query("linreg_holdout", _HOLDOUT_SQL)
def linreg_holdout(spark, sf):
    """The tuned job with a grid of one point, where SQL can follow all of it."""
    return _holdout(tuning.tune_linreg, spark, sf)


@query("pipeline_holdout", _HOLDOUT_SQL)
def pipeline_holdout(spark, sf):
    """The same as one pipeline."""
    return _holdout(tuning.tune_linreg_pipeline, spark, sf)


def _holdout(tune, spark, sf):
    report = tune(
        _net_quantities(spark, sf), "l_quantity", ["net_quantity"],
        reg=[0.1], elastic=[0.0], key="l_orderkey",
    ).report
    return report.select(
        F.round("intercept", 5).alias("intercept"),
        F.round(F.col("coefficients")[0], 5).alias("slope"),
        F.round("rmse_train", 5).alias("rmse_train"), F.round("r2_train", 6).alias("r2_train"),
        F.round("rmse_holdout", 5).alias("rmse_holdout"), F.round("r2_holdout", 6).alias("r2_holdout"),
        "reg_param", "elastic_net_param",
    )


@query("linreg_tuned")
def linreg_tuned(spark, sf):
    return tuning.tune_linreg(
        _lines(spark, sf), "l_extendedprice", _LINE_NUMERIC, ["l_returnflag"], key="l_orderkey"
    ).report


@query("linreg_grid")
def linreg_grid(spark, sf):
    """Validation metric of every grid point."""
    return tuning.tune_linreg(
        _lines(spark, sf), "l_extendedprice", _LINE_NUMERIC, ["l_returnflag"], key="l_orderkey"
    ).grid


@query("pipeline_tuned")
def pipeline_tuned(spark, sf):
    return tuning.tune_linreg_pipeline(
        _lines(spark, sf), "l_extendedprice", _LINE_NUMERIC, ["l_returnflag"], key="l_orderkey"
    ).report


@query("next_month_views")
def next_month_views(spark, sf):
    return viewing.next_month_views(_customers(spark, sf), key="c_custkey").report


# --- classification ---------------------------------------------------------------


@query(
    "logreg_fit",
    """
    SELECT o_orderpriority, count(*) AS orders,
           round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE), 4) AS likelihood,
           CASE WHEN avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) > 0.5
                THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM orders GROUP BY o_orderpriority
    """,
)
def logreg_fit(spark, sf):
    """Finished orders by priority. With one category as the only feature, the likelihood
    of each category is its share of positives."""
    orders = read_table(spark, sf, "orders").select(
        "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("finished")
    )
    scored = classification.logreg(orders, "finished", [], ["o_orderpriority"], tolerance=1e-12)
    return scored.groupBy("o_orderpriority", F.round("likelihood", 4).alias("likelihood"), "prediction").agg(
        F.count(F.lit(1)).alias("orders")
    )


_RULE_SQL = """
    rows_of AS (
        SELECT o_orderpriority, CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS label,
               CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '/42'), 1, 8) AS BIGINT)
                   < CAST(floor(0.2 * 4294967296) AS BIGINT) AS held
        FROM orders
    ),
    rule AS (
        SELECT o_orderpriority, CASE WHEN avg(label) > 0.5 THEN 1 ELSE 0 END AS prediction
        FROM rows_of WHERE NOT held GROUP BY o_orderpriority
    )
"""


def _one_category_sql(model):
    return f"""
    WITH {_RULE_SQL}
    SELECT '{model}' AS model, count(*) AS holdout_rows,
           round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END::DOUBLE), 8) AS accuracy
    FROM rows_of JOIN rule USING (o_orderpriority) WHERE held
    """


def _one_category(spark, sf, model):
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", C.at_least("o_totalprice", 250000).alias("label")
    )
    found = trees.tree_vs_forest(
        orders, "label", [], ["o_orderpriority"], key="o_orderkey", models=[model], bootstrap=False
    )
    return found.select("model", "holdout_rows", F.round("accuracy", 8).alias("accuracy"))


@query("tree_one_category", _one_category_sql("tree"))
def tree_one_category(spark, sf):
    """Dear orders by priority. A tree over one category says each category's majority."""
    return _one_category(spark, sf, "tree")


@query("forest_one_category", _one_category_sql("forest"))
def forest_one_category(spark, sf):
    """Trees that all see every row of one category agree: the forest says the same."""
    return _one_category(spark, sf, "forest")


@query("churn_logistic")
def churn_logistic(spark, sf):
    return viewing.stop_watching(_customers(spark, sf), key="c_custkey").report


@query("churn_confusion")
def churn_confusion(spark, sf):
    return viewing.stop_watching(_customers(spark, sf), key="c_custkey").confusion


_PREDICTED_SQL = """
    predicted AS (
        SELECT quality AS label, CASE WHEN n_chars > 1500 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
        FROM labels JOIN documents USING (doc_id)
    ),
    cells AS (
        SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp,
               count(*) FILTER (label = 0 AND prediction = 1) AS fp,
               count(*) FILTER (label = 0 AND prediction = 0) AS tn,
               count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM predicted
    ),
    rates AS (
        SELECT *, tp / (tp + fn) AS tpr1, fp / (fp + tn) AS fpr1,
               tn / (tn + fp) AS tpr0, fn / (fn + tp) AS fpr0 FROM cells
    )
"""


def _labelled(spark, sf):
    documents = read_table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return read_table(spark, sf, "labels").join(documents, "doc_id")


def _predicted(spark, sf):
    """A rule as the classifier: long documents are good ones."""
    return _labelled(spark, sf).select(
        F.col("quality").alias("label"),
        F.when(F.col("n_chars") > 1500, 1.0).otherwise(0.0).alias("prediction"),
    )


@query(
    "confusion",
    f"WITH {_PREDICTED_SQL} SELECT label, prediction, count(*) AS count FROM predicted GROUP BY ALL",
)
def confusion(spark, sf):
    return metrics.confusion(_predicted(spark, sf))


@query(
    "accuracy",
    f"WITH {_PREDICTED_SQL} SELECT count(*) AS rows, "
    "round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END::DOUBLE), 8) AS accuracy FROM predicted",
)
def accuracy(spark, sf):
    return metrics.accuracy(_predicted(spark, sf)).withColumn("accuracy", F.round("accuracy", 8))


@query(
    "class_rates",
    f"""
    WITH {_PREDICTED_SQL}
    SELECT 0 AS label, round(tpr0, 8) AS tpr, round(fpr0, 8) AS fpr FROM rates
    UNION ALL SELECT 1, round(tpr1, 8), round(fpr1, 8) FROM rates
    """,
)
def class_rates(spark, sf):
    rates = metrics.class_rates(_predicted(spark, sf))
    return rates.withColumns({"tpr": F.round("tpr", 8), "fpr": F.round("fpr", 8)})


@query(
    "class_likelihoods",
    f"""
    WITH {_PREDICTED_SQL}
    SELECT round((tp + tn) / (tp + tn + fp + fn), 8) AS accuracy,
           round(tpr1, 8) AS recall_pos, round(tpr0, 8) AS recall_neg,
           round(tpr1 / (tpr1 + fpr1), 8) AS likelihood_pos,
           round(tpr0 / (tpr0 + fpr0), 8) AS likelihood_neg
    FROM rates
    """,
)
def class_likelihoods(spark, sf):
    found = metrics.class_likelihoods(_predicted(spark, sf))
    return found.withColumns({c: F.round(c, 8) for c in found.columns})


_TRIALS_SQL = f"""
    SELECT doc_id,
           CASE WHEN upper(lang) IN ('GB', 'US', 'IN', 'UNKNOWN') THEN upper(lang)
                WHEN upper(lang) IN ({", ".join(f"'{c}'" for c in C.EUROPEAN_COUNTRIES)}) THEN 'EUROPE'
                ELSE 'OTHER' END AS country,
           CAST(substr(source, 4) AS INTEGER) AS rebill_period,
           quality + toxic AS payments_made, n_chars AS chapter_access_count,
           CASE WHEN quality + toxic >= 1 THEN 1 ELSE 0 END AS label
    FROM labels JOIN documents USING (doc_id)
"""


def _trials(spark, sf):
    """A labelled document as a trial: its labels are the payments, its length the use."""
    return trial_rows(
        _labelled(spark, sf).select(
            "doc_id",
            F.upper("lang").alias("country"),
            F.substring("source", 4, 9).cast("int").alias("rebill_period"),
            (F.col("quality") + F.col("toxic")).alias("payments_made"),
            F.col("n_chars").alias("chapter_access_count"),
        )
    )


@query("trial_labels", _TRIALS_SQL)
def trial_labels(spark, sf):
    return _trials(spark, sf)


def _tree(spark, sf, model):
    return trees.tree_vs_forest(
        _trials(spark, sf), "label", ["rebill_period", "chapter_access_count"], ["country"],
        key="doc_id", models=[model],
    )


@query("tree_accuracy")
def tree_accuracy(spark, sf):
    return _tree(spark, sf, "tree")


@query("forest_accuracy")
def forest_accuracy(spark, sf):
    return _tree(spark, sf, "forest")


# --- clusters ---------------------------------------------------------------------


def _vectors(spark, sf):
    return read_table(spark, sf, "embeddings").select(
        array_to_vector("embedding").alias("features"), F.col("label").cast("double").alias("prediction")
    )


@query(
    "kmeans_separated",
    "SELECT 3 AS k, 0.0::DOUBLE AS sse, 1.0::DOUBLE AS silhouette, count(*) AS size "
    "FROM lineitem GROUP BY l_returnflag",
)
def kmeans_separated(spark, sf):
    """Lines at as many places as there are flags: the clusters must be those places."""
    lines = read_table(spark, sf, "lineitem").select("l_returnflag")
    found = clusters.kmeans_sweep(lines, [], ["l_returnflag"], ks=[3])
    return found.select(
        "k", F.round("sse", 6).alias("sse"), F.round("silhouette", 6).alias("silhouette"),
        F.explode("sizes").alias("size"),
    )


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    return clusters.kmeans_sweep(_vectors(spark, sf), features="features")


@query("kmeans_shared")
def kmeans_shared(spark, sf):
    """The sweep with all numbers of clusters fitted by the same scans."""
    return shared_clusters.kmeans_shared(_vectors(spark, sf)).drop("distances")


@query(
    "kmeans_shared_separated",
    """
    WITH flags AS (SELECT l_returnflag AS f, count(*)::DOUBLE AS n FROM lineitem GROUP BY f),
    merged AS (
        SELECT 2 * a.n * b.n / (a.n + b.n) AS cost, a.n + b.n AS together
        FROM flags a JOIN flags b ON a.f < b.f ORDER BY cost LIMIT 1
    )
    SELECT 3 AS k, 0.0::DOUBLE AS sse, n::BIGINT AS size FROM flags
    UNION ALL SELECT 2, round(cost, 4), unnest([together, (SELECT sum(n) FROM flags) - together])::BIGINT FROM merged
    """,
)
def kmeans_shared_separated(spark, sf):
    """Lines at three places of equal distances: three clusters are those places, and two join
    the pair of places that costs least."""
    flags = [F.when(F.col("l_returnflag") == f, 1.0).otherwise(0.0) for f in "ANR"]
    places = read_table(spark, sf, "lineitem").select(F.array(*flags).alias("features"))
    found = shared_clusters.kmeans_shared(places, ks=[2, 3])
    return found.select("k", F.round("sse", 4).alias("sse"), F.explode("sizes").alias("size"))


@query(
    "cluster_sizes",
    "SELECT CAST(label AS DOUBLE) AS prediction, count(*) AS count FROM embeddings GROUP BY label",
)
def cluster_sizes(spark, sf):
    return _vectors(spark, sf).groupBy("prediction").agg(F.count(F.lit(1)).alias("count"))


@query(
    "silhouette_given",
    """
    WITH entries AS (
        SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS d
        FROM embeddings
    ),
    norms AS (SELECT vec_id, label, sum(x * x) AS q FROM entries GROUP BY ALL),
    cluster_n AS (SELECT label, count(*) AS n, sum(q) AS psi FROM norms GROUP BY label),
    cluster_sum AS (SELECT label, d, sum(x) AS y FROM entries GROUP BY ALL),
    dots AS (
        SELECT e.vec_id, e.label AS own, c.label AS other, sum(e.x * c.y) AS dot
        FROM entries e JOIN cluster_sum c USING (d) GROUP BY ALL
    ),
    distances AS (
        SELECT vec_id, own, other, n, q + psi / n - 2 * dot / n AS dist
        FROM dots JOIN cluster_n c ON c.label = other JOIN norms USING (vec_id)
    ),
    scored AS (
        SELECT vec_id,
               max(CASE WHEN own = other AND n > 1 THEN dist * n / (n - 1) END) AS a,
               min(CASE WHEN own <> other THEN dist END) AS b
        FROM distances GROUP BY vec_id
    )
    SELECT round(avg(CASE WHEN a IS NULL THEN 0 WHEN a < b THEN 1 - a / b
                          WHEN a > b THEN b / a - 1 ELSE 0 END), 8) AS silhouette
    FROM scored
    """,
)
def silhouette_given(spark, sf):
    value = metrics.silhouette(_vectors(spark, sf))
    return spark.createDataFrame([(round(value, 8),)], "silhouette double")


# --- recommendations --------------------------------------------------------------


def _ratings(spark, sf):
    """Quantity of each part per customer."""
    lines = read_table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (
        lookup_join(lines, orders, "o_orderkey", spread=["l_partkey", "l_linenumber", "l_suppkey"])
        .groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("courseId"))
        .agg(F.sum("l_quantity").alias("rating"))
    )


@query("als_top5")
def als_top5(spark, sf):
    return recommend.recommend(_ratings(spark, sf), 5)


@query(
    "als_pruned_agrees",
    """
    SELECT count(DISTINCT o_custkey) AS users, count(DISTINCT o_custkey) AS agreeing
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def als_pruned_agrees(spark, sf):
    """Users whose five best ratings are the same with and without scoring all pairs."""
    model = recommend.fit_ratings(_ratings(spark, sf))
    full = recommend.best_for_all(model, 5, pruned=False)
    pruned = recommend.best_for_all(model, 5).withColumnRenamed("recommendations", "pruned")
    paired = F.zip_with("recommendations", "pruned", lambda a, b: F.abs(a["rating"] - b["rating"]) <= 1e-4 * (1 + F.abs(a["rating"])))
    same = F.forall(paired, lambda x: F.coalesce(x, F.lit(False)))
    return full.join(pruned, "userId", "full").agg(
        F.count(F.lit(1)).alias("users"), F.sum(F.coalesce(same, F.lit(False)).cast("bigint")).alias("agreeing")
    )


#: The priorities of orders.
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _sums(values):
    return ", ".join(f"sum(CASE WHEN o_orderpriority = '{p}' THEN {values} ELSE 0 END)::DOUBLE AS p{n}" for n, p in enumerate(_PRIORITIES))


@query(
    "affinity_top5",
    f"""
    WITH users AS (SELECT o_custkey, {_sums("1")} FROM orders GROUP BY o_custkey),
    items AS (SELECT l_partkey, {_sums("l_quantity")} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey),
    scored AS (
        SELECT o_custkey, l_partkey, {" + ".join(f"u.p{n} * i.p{n}" for n in range(len(_PRIORITIES)))} AS score
        FROM users u, items i
    )
    SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, l_partkey)::INTEGER AS rank,
           l_partkey AS item, score
    FROM scored QUALIFY rank <= 5
    """,
)
def affinity_top5(spark, sf):
    """Parts whose quantities by priority go best with a customer's orders by priority."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = read_table(spark, sf, "lineitem").select("l_partkey", "l_linenumber", "l_quantity", F.col("l_orderkey").alias("o_orderkey"))
    lines = lookup_join(lines, orders, "o_orderkey", spread=["l_partkey", "l_linenumber"])

    def vector(value):
        return F.array(*[F.sum(F.when(F.col("o_orderpriority") == p, value).otherwise(0)).cast("double") for p in _PRIORITIES]).alias("features")

    found = best_products(
        orders.groupBy("o_custkey").agg(vector(F.lit(1))), lines.groupBy("l_partkey").agg(vector(F.col("l_quantity"))), 5, "o_custkey", "l_partkey"
    )
    return found.drop("n_scored")


@query(
    "recs_with_history",
    """
    SELECT o_custkey AS userId, l_partkey AS courseId,
           sum(l_quantity) AS rating, 5 AS recommended
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def recs_with_history(spark, sf):
    """Each user's history with the number of recommendations beside it."""
    ratings = checkpointed(_ratings(spark, sf))
    recs = checkpointed(recommend.recommend(ratings, 5))
    return recommend.with_history(recs, ratings).select(
        "userId", "courseId", "rating", F.size("recommendations").alias("recommended")
    )
