"""Joins in time, regression, cubes and sketches over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorestream.catalog.bayes import GAUSSIAN_SQL, predict_shape
from scorestream.catalog.registry import query, table
from scorestream.operators.asof import asof_join
from scorestream.operators.regression import fit_linear
from scorestream.operators.summaries import SKETCH_ERROR, accuracy_cube, distinct_sketches, frequent_items, merged_distinct
from scorestream.workspace import materialize

_ORDERED_SQL = """
ordered AS (
    SELECT o_orderkey, o_custkey % 1500 AS user_id,
           TIMESTAMP '2024-01-01' + to_minutes((o_orderkey * 37 % 43200)::BIGINT) AS ordered_at
    FROM orders
)
"""


@query(
    "asof_last_event",
    f"""
    WITH {_ORDERED_SQL}
    SELECT o.o_orderkey, o.user_id, epoch_us(o.ordered_at) AS ordered_at, e.event_id, e.event_type
    FROM ordered o ASOF LEFT JOIN events e ON o.user_id = e.user_id AND o.ordered_at >= e.ts
    """,
)
def asof_last_event(spark, sf_dir):
    """The last event of the user before each order."""
    minutes = F.make_dt_interval(mins=(F.col("o_orderkey") * 37 % 43200).cast("int"))
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(
        "o_orderkey",
        (F.col("o_custkey") % 1500).alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + minutes).alias("ordered_at"),
    )
    events = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    at = lambda c: F.col(c).cast("timestamp_ntz").cast("timestamp")
    orders = orders.withColumn("ordered_at", at("ordered_at"))
    events = events.withColumn("ts", at("ts"))
    found = asof_join(orders, events, "user_id", "ordered_at", "ts", ["event_id", "event_type"])
    return found.withColumn("ordered_at", F.unix_micros("ordered_at"))


@query(
    "linear_regression_one",
    """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem
    """,
)
def linear_regression_one(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem", "l_extendedprice", "l_quantity")
    model = fit_linear(rows, ["l_quantity"], "l_extendedprice")
    return spark.createDataFrame(
        [(round(model.slopes[0], 4), round(model.intercept, 3))], "slope double, intercept double"
    )


@query(
    "linear_regression_predict",
    """
    WITH moments AS (
        SELECT avg(l_quantity) AS mq, avg(l_tax) AS mt, avg(l_extendedprice) AS mp, var_pop(l_quantity) AS qq,
               var_pop(l_tax) AS tt, covar_pop(l_quantity, l_tax) AS qt, covar_pop(l_quantity, l_extendedprice) AS qp,
               covar_pop(l_tax, l_extendedprice) AS tp
        FROM lineitem
    ), solved AS (
        SELECT *, (qp * tt - tp * qt) / (qq * tt - qt * qt) AS bq, (tp * qq - qp * qt) / (qq * tt - qt * qt) AS bt FROM moments
    )
    SELECT l_orderkey, l_linenumber, round(mp + bq * (l_quantity - mq) + bt * (l_tax - mt), 3) AS prediction
    FROM lineitem, solved
    """,
)
def linear_regression_predict(spark, sf_dir):
    """Price on quantity and tax, every line predicted."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax")
    model = fit_linear(rows, ["l_quantity", "l_tax"], "l_extendedprice")
    return rows.select("l_orderkey", "l_linenumber", F.round(model.prediction(), 3).alias("prediction"))


@query(
    "accuracy_cube",
    f"""
    WITH {GAUSSIAN_SQL}
    SELECT source, fold, p.lang, grouping_id(source, fold, p.lang)::BIGINT AS level, count(*) AS n_rows,
           sum(CASE WHEN p.prediction = p.lang THEN 1 ELSE 0 END)::BIGINT AS n_correct,
           round(avg(CASE WHEN p.prediction = p.lang THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy
    FROM predicted p JOIN (SELECT doc_id, source, doc_id % 3 AS fold FROM documents) d USING (doc_id)
    GROUP BY CUBE (source, fold, p.lang)
    """,
)
def accuracy_cube_of_documents(spark, sf_dir):
    """Rows and right predictions for every source, fold and language, and all sums over them."""
    known = table(spark, sf_dir, "documents", "doc_id", "source").withColumn("fold", F.col("doc_id") % 3)
    scored = predict_shape(spark, sf_dir).select("doc_id", "lang", "prediction").join(known, "doc_id")
    cube = accuracy_cube(scored, "lang", "prediction", ["source", "fold", "lang"])
    return cube.withColumn("accuracy", F.round("accuracy", 9))


@query(
    "distinct_users_sketched",
    """
    SELECT ts::DATE::VARCHAR AS day, count(DISTINCT user_id) AS n_users, true AS near FROM events GROUP BY 1
    UNION ALL SELECT 'all', count(DISTINCT user_id), true FROM events
    """,
)
def distinct_users_sketched(spark, sf_dir):
    """Distinct users per day and, from the same sketches merged, over all days; four standard errors are near."""
    events = table(spark, sf_dir, "events", "ts", "user_id").select(F.to_date("ts").cast("string").alias("day"), "user_id")
    sketches = materialize(distinct_sketches(events, ["day"], "user_id"), "user-sketches")
    estimated = merged_distinct(sketches, ["day"]).unionAll(
        merged_distinct(sketches.withColumn("day", F.lit("all")), ["day"])
    )
    pairs = events.distinct()
    exact = pairs.groupBy("day").agg(F.count("*").alias("n_users")).unionAll(
        pairs.select("user_id").distinct().agg(F.count("*")).select(F.lit("all"), "count(1)")
    )
    off = F.abs(F.col("n_distinct") - F.col("n_users"))
    near = off <= F.greatest(4 * SKETCH_ERROR * F.col("n_users"), F.lit(1))
    return exact.join(estimated, "day").select("day", "n_users", near.alias("near"))


@query(
    "frequent_event_types",
    "SELECT ts::DATE::VARCHAR AS day, event_type AS item, count(*) AS count FROM events GROUP BY ALL",
)
def frequent_event_types(spark, sf_dir):
    """The types of events of each day from sketches that follow more values than there are, so they are exact."""
    events = table(spark, sf_dir, "events", "ts", "event_type")
    events = events.select(F.to_date("ts").cast("string").alias("day"), "event_type")
    return frequent_items(events, "event_type", 20, ["day"])
