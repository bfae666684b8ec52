"""Iterative estimators on inputs whose answer SQL can state.

On one indicator per category a saturated model predicts every category's most
frequent class; a tree of depth one on a column of few values is the best of a
few splits; components keep trace and norm of the covariance; cross-validated
naive Bayes has a closed form in every fold.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorestream.catalog.columns import SHAPE_SQL, TRAIN_SQL, stored_shape
from scorestream.catalog.registry import query, table
from scorestream.catalog.text import documents
from scorestream.operators import classifiers, features, optimality
from scorestream.operators.sets import union_all
from scorestream.operators.split import fold_column, is_train, random_split
from scorestream.plans.tabular import TabularPlan
from scorestream.sources.batch import driver_rows
from scorestream.workspace import materialize

#: Category of a text: the first of these letters that it has, by position; 0 without any.
_LETTERS = ["ñ", "ß", "è"]
_MARKED_SQL = (
    "marked AS (SELECT doc_id, lang, CASE "
    + " ".join(f"WHEN contains(text, '{c}') THEN {i + 1}" for i, c in enumerate(_LETTERS))
    + " ELSE 0 END AS category FROM documents)"
)
_MODES_SQL = f"""
WITH {_MARKED_SQL}, modes AS (
    SELECT category, mode(lang) AS prediction FROM marked WHERE {TRAIN_SQL} GROUP BY category
)
SELECT doc_id, prediction FROM marked JOIN modes USING (category)
"""
_STUMP_SQL = f"""
WITH {_MARKED_SQL}, sides AS (
    SELECT t, category <= t AS low, lang, count(*) AS n
    FROM marked, (VALUES (0), (1), (2)) AS cuts(t) WHERE {TRAIN_SQL} GROUP BY ALL
), impure AS (
    SELECT t, low, sum(n) - sum(n * n)::DOUBLE / sum(n) AS gini FROM sides GROUP BY t, low
), best AS (
    SELECT t FROM impure GROUP BY t HAVING count(*) = 2 ORDER BY sum(gini), t LIMIT 1
), votes AS (
    SELECT low, arg_max(lang, n) AS prediction FROM sides JOIN best USING (t) GROUP BY low
)
SELECT doc_id, prediction FROM marked CROSS JOIN best JOIN votes ON votes.low = (category <= t)
"""


def _marked(spark, sf_dir):
    category = F.lit(0)
    for i, letter in reversed(list(enumerate(_LETTERS))):
        category = F.when(F.contains("text", F.lit(letter)), i + 1).otherwise(category)
    rows = documents(spark, sf_dir, "lang").select("doc_id", "lang", category.cast("double").alias("category"))
    shown = [(F.col("category") == i).cast("double").alias(f"is_{i}") for i in range(len(_LETTERS) + 1)]
    return materialize(rows.select("*", *shown), "marked")


def _saturated(classifier, **how):
    def run(spark, sf_dir):
        rows = _marked(spark, sf_dir)
        columns = [c for c in rows.columns if c.startswith("is_")]
        plan = TabularPlan("doc_id", columns, "lang", classifier, **how)
        scored = plan.score(plan.fit(rows), rows)
        return scored.select("doc_id", F.col("predicted_label").alias("prediction"))

    return run


query("saturated_lr", _MODES_SQL)(_saturated("lr", reg=0.0, max_iter=100))
query("saturated_ovr", _MODES_SQL)(_saturated("ovr", reg=0.0, max_iter=100))
query("saturated_svc", _MODES_SQL)(_saturated("svc", reg=0.01, max_iter=5))
query("saturated_mlp", _MODES_SQL)(_saturated("mlp", max_iter=200))


@query("logistic_optimality", f"SELECT count(*) AS n_rows, true AS optimal FROM documents WHERE {TRAIN_SQL}")
def logistic_optimality(spark, sf_dir):
    """Is the penalised multinomial loss stationary at the fitted weights, on free measurements?

    The loss is convex, so a vanishing slope proves the fit; it is summed over all
    training rows by one aggregate.
    """
    rows = stored_shape(spark, sf_dir).where(is_train("doc_id"))
    stages = [features.index_label("lang"), features.assemble(features.SHAPE_COLUMNS), features.scale(mean=True)]
    known = Pipeline(stages=stages).fit(rows).transform(rows).select("label", "scaled")
    known = materialize(known, "scaled-shape")
    model = classifiers.logistic("scaled", maxIter=500, tol=1e-12, regParam=0.01, standardization=False).fit(known)
    slope = optimality.logistic_slope(model, known, "scaled", "label")
    worst = float(abs(slope).max())
    return known.agg(F.count("*").alias("n_rows"), F.lit(worst < 1e-5).alias("optimal"))


def _fitted_tree(rows, columns, tree):
    train = rows.where(is_train("doc_id"))
    indexer = features.index_label("lang").fit(train)
    stages = [indexer, features.assemble(columns), tree, features.unindex_label(indexer.labels)]
    scored = Pipeline(stages=stages).fit(train).transform(rows)
    return scored.select("doc_id", F.col("predicted_label").alias("prediction"))


def _stump(make):
    return lambda spark, sf_dir: _fitted_tree(_marked(spark, sf_dir), ["category"], make())


query("stump_tree", _STUMP_SQL)(_stump(lambda: classifiers.decision_tree(maxDepth=1)))
query("stump_forest", _STUMP_SQL)(
    _stump(lambda: classifiers.random_forest(trees=3, maxDepth=1, bootstrap=False, featureSubsetStrategy="all"))
)

#: Two counts of letters per document, capped so that every value can be a threshold.
_SIGNS = {"a": "[w]", "b": "[z]"}
_SIGN_CAP = 15


def _nested_sql(depth: int) -> str:
    """A tree grown level by level: the best cut of every node, then the rows one level down."""
    signs = ", ".join(
        f"least(length(text) - length(regexp_replace(text, '{p}', '', 'g')), {_SIGN_CAP}) AS {c}" for c, p in _SIGNS.items()
    )
    steps = [f"rows_0 AS (SELECT doc_id, lang, {signs}, {TRAIN_SQL} AS train, '' AS node FROM documents)"]
    cuts = " UNION ALL ".join(
        f"SELECT '{c}' AS f, (x + lead(x) OVER (ORDER BY x)) / 2.0 AS t FROM (SELECT DISTINCT {c} AS x FROM rows_0 WHERE train)"
        for c in _SIGNS
    )
    steps.append(f"cuts AS (SELECT * FROM ({cuts}) WHERE t IS NOT NULL)")
    value = "CASE f " + " ".join(f"WHEN '{c}' THEN {c}" for c in _SIGNS) + " END"
    impurity = "sum(n) - sum(n * n)::DOUBLE / sum(n) AS gini"
    for k in range(depth):
        steps += [
            f"sides_{k} AS (SELECT node, f, t, {value} <= t AS low, lang, count(*) AS n FROM rows_{k}, cuts WHERE train GROUP BY ALL)",
            f"impure_{k} AS (SELECT node, f, t, low, {impurity} FROM sides_{k} GROUP BY node, f, t, low)",
            f"whole_{k} AS (SELECT node, {impurity} FROM (SELECT node, lang, count(*) AS n FROM rows_{k} WHERE train GROUP BY ALL) GROUP BY node)",
            f"gains_{k} AS (SELECT node, f, t, any_value(w.gini) - sum(i.gini) AS gain FROM impure_{k} i JOIN whole_{k} w USING (node) "
            "GROUP BY node, f, t HAVING count(*) = 2)",
            f"best_{k} AS (SELECT node, f, t FROM gains_{k} WHERE gain > 1e-9 "
            "QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, t) = 1)",
            f"rows_{k + 1} AS (SELECT r.* EXCLUDE (node), r.node || CASE WHEN f IS NULL THEN '' WHEN {value} <= t THEN 'l' ELSE 'r' END AS node "
            f"FROM rows_{k} r LEFT JOIN best_{k} USING (node))",
        ]
    steps += [
        f"votes AS (SELECT node, lang, count(*) AS n FROM rows_{depth} WHERE train GROUP BY ALL)",
        "sizes AS (SELECT lang, count(*) AS size FROM rows_0 WHERE train GROUP BY lang)",
        "leaves AS (SELECT node, lang AS prediction FROM votes JOIN sizes USING (lang) "
        "QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, size DESC, lang) = 1)",
    ]
    return "WITH " + ", ".join(steps) + f" SELECT doc_id, prediction FROM rows_{depth} JOIN leaves USING (node)"


def _grown(make):
    def run(spark, sf_dir):
        def capped(pattern):
            found = F.length("text") - F.length(F.regexp_replace("text", pattern, ""))
            return F.least(found, F.lit(_SIGN_CAP)).cast("double")

        signs = {c: capped(p) for c, p in _SIGNS.items()}
        rows = materialize(documents(spark, sf_dir, "lang").withColumns(signs).drop("text"), "signs")
        return _fitted_tree(rows, list(signs), make())

    return run


query("grown_tree", _nested_sql(3))(_grown(lambda: classifiers.decision_tree(maxDepth=3)))
query("grown_forest", _nested_sql(3))(
    _grown(lambda: classifiers.random_forest(trees=3, maxDepth=3, bootstrap=False, featureSubsetStrategy="all"))
)


@query(
    "pca_invariants",
    f"""
    WITH {SHAPE_SQL}, pairs AS (
        SELECT corr(n_words, avg_word) AS a, corr(n_words, ascii_share) AS b, corr(n_words, mark_share) AS c,
               corr(avg_word, ascii_share) AS d, corr(avg_word, mark_share) AS e, corr(ascii_share, mark_share) AS f
        FROM shape
    )
    SELECT 4.0::DOUBLE AS trace, round(4 + 2 * (a*a + b*b + c*c + d*d + e*e + f*f), 6) AS squared_norm FROM pairs
    """,
)
def pca_invariants(spark, sf_dir):
    """Variances of all components of scaled features: their sum, and the sum of their squares."""
    rows = stored_shape(spark, sf_dir)
    width = len(features.SHAPE_COLUMNS)
    stages = [
        features.assemble(features.SHAPE_COLUMNS),
        features.scale(mean=True),
        features.principal_components(width, "scaled"),
    ]
    values = vector_to_array(F.col("components"))
    parts = Pipeline(stages=stages).fit(rows).transform(rows).select(*(values[i].alias(f"c{i}") for i in range(width)))
    variances = parts.agg(*(F.var_samp(f"c{i}").alias(f"v{i}") for i in range(width)))
    v = [F.col(f"v{i}") for i in range(width)]
    return variances.select(
        F.round(sum(v[1:], v[0]), 6).alias("trace"), F.round(sum((x * x for x in v[1:]), v[0] * v[0]), 6).alias("squared_norm")
    )


_SMOOTHINGS = [0.5, 5.0, 50.0, 500.0]


@query(
    "cross_validated_smoothing",
    f"""
    WITH votes AS (
        SELECT doc_id, lang, ('0x' || substr(md5('fold-' || doc_id::VARCHAR), 1, 8))::BIGINT % 3 AS fold,
               length(text) - length(replace(text, chr(10), '')) AS a,
               length(text) - length(regexp_replace(text, '[?!]', '', 'g')) AS b,
               length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS c
        FROM documents
    ), grid AS (
        SELECT unnest({_SMOOTHINGS})::DOUBLE AS s
    ), fitted AS (
        SELECT held, lang, count(*) AS n, sum(a) AS sa, sum(b) AS sb, sum(c) AS sc
        FROM votes, (VALUES (0), (1), (2)) AS folds(held) WHERE fold <> held GROUP BY held, lang
    ), model AS (
        SELECT held, s, lang,
               ln(n + s) - ln(sum(n) OVER w + s * count(*) OVER w) AS prior,
               ln(sa + s) - ln(sa + sb + sc + 3 * s) AS ta, ln(sb + s) - ln(sa + sb + sc + 3 * s) AS tb,
               ln(sc + s) - ln(sa + sb + sc + 3 * s) AS tc
        FROM fitted, grid WINDOW w AS (PARTITION BY held, s)
    ), predicted AS (
        SELECT v.doc_id, m.held, m.s, v.lang, arg_max(m.lang, prior + a * ta + b * tb + c * tc) AS prediction
        FROM votes v JOIN model m ON m.held = v.fold GROUP BY ALL
    ), measured AS (
        SELECT held, s, avg(CASE WHEN lang = prediction THEN 1 ELSE 0 END) AS accuracy FROM predicted GROUP BY held, s
    ), averaged AS (
        SELECT s AS smoothing, round(avg(accuracy), 6) AS accuracy FROM measured GROUP BY s
    )
    SELECT smoothing, accuracy,
           row_number() OVER (ORDER BY accuracy DESC, smoothing) = 1 AS chosen
    FROM averaged
    """,
)
def cross_validated_smoothing(spark, sf_dir):
    """Mean accuracy of every smoothing over three hashed folds, and the one that is chosen."""
    rows = features.text_votes(documents(spark, sf_dir, "lang")).drop("text")
    rows = materialize(fold_column(rows, "doc_id", 3), "folds")
    bayes = classifiers.multinomial_bayes()
    stages = [features.index_label("lang"), features.assemble(features.VOTE_COLUMNS), bayes]
    search = classifiers.cross_validator(
        Pipeline(stages=stages), {bayes.smoothing: _SMOOTHINGS}, "accuracy", folds=3, fold_column="fold"
    )
    tuned = search.fit(rows)
    chosen = tuned.bestModel.stages[-1].getOrDefault("smoothing")
    found = [(s, round(float(m), 6), s == chosen) for s, m in zip(_SMOOTHINGS, tuned.avgMetrics)]
    return spark.createDataFrame(found, "smoothing double, accuracy double, chosen boolean")


@query(
    "random_split_parts",
    "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_distinct, true AS near_share FROM orders",
)
def random_split_parts(spark, sf_dir):
    """A seeded random split: no row in both parts, none in neither, shares about as asked."""
    parts = random_split(table(spark, sf_dir, "orders", "o_orderkey"), (0.8, 0.2), seed=100)
    labelled = union_all(*(p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)))
    share = F.avg((F.col("part") == 0).cast("double"))
    return labelled.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("o_orderkey").alias("n_distinct"),
        share.between(0.75, 0.85).alias("near_share"),
    )


@query(
    "driver_rows_join",
    """
    SELECT o_orderkey, rank FROM orders
    JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('5-LOW', 5)) AS ranks(o_orderpriority, rank) USING (o_orderpriority)
    """,
)
def driver_rows_join(spark, sf_dir):
    """A few rows made in the driver, joined with a table that grows."""
    ranks = driver_rows(spark, [("1-URGENT", 1), ("2-HIGH", 2), ("5-LOW", 5)], "o_orderpriority string, rank int")
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").join(ranks, "o_orderpriority").drop("o_orderpriority")
