"""Jobs that train library classifiers.

Iterative optimisers have no SQL form; those queries return the train and test
metrics of the whole table.  Naive Bayes has one, and is checked row by row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scorestream.catalog.bayes import (
    FULL_SQL,
    GAUSSIAN_SQL,
    IDF_SQL,
    PREDICT_SQL,
    TERM_PREDICTION_SQL,
    fit_sql,
    model_sql,
)
from scorestream.catalog.columns import TRAIN_SQL, stored_shape
from scorestream.catalog.registry import query, table
from scorestream.catalog.text import STOP_SQL, WORDS_SQL, documents, stem_sql
from scorestream.functions.labels import lookup
from scorestream.operators.features import SHAPE_COLUMNS, VOTE_COLUMNS, text_votes
from scorestream.plans.review import ReviewPlan
from scorestream.plans.tabular import TabularPlan
from scorestream.sources.artifacts import chain_models, load_pipeline, save_model
from scorestream.workspace import materialize, scratch_path


#: Metrics of train and test rows over a CTE (doc_id, lang, prediction).
_PARTS_SQL = """
parts_confusion AS (
    SELECT CASE WHEN {train} THEN 'train' ELSE 'test' END AS part, lang AS label, prediction,
           count(*) AS n
    FROM {predicted} GROUP BY ALL
), parts_sides AS (
    SELECT part, class, sum(support) AS support, sum(guessed) AS guessed, sum(hit) AS hit FROM (
        SELECT part, label AS class, n AS support, 0 AS guessed,
               CASE WHEN label = prediction THEN n ELSE 0 END AS hit FROM parts_confusion
        UNION ALL SELECT part, prediction, 0, n, 0 FROM parts_confusion
    ) GROUP BY part, class
), parts_measured AS (
    SELECT part, sum(support)::DOUBLE AS n_rows, sum(hit)::DOUBLE / sum(support) AS accuracy,
           sum(support * (2.0::DOUBLE * hit / (support + guessed))) / sum(support) AS weighted_f1
    FROM parts_sides GROUP BY part
)
SELECT part, 'n_rows' AS metric, n_rows AS value FROM parts_measured
UNION ALL SELECT part, 'accuracy', round(accuracy, 6) FROM parts_measured
UNION ALL SELECT part, 'weighted_f1', round(weighted_f1, 6) FROM parts_measured
UNION ALL SELECT part, 'error_rate', round(1 - accuracy, 6) FROM parts_measured
"""

_SCALED_GNB_SQL = (
    "WITH "
    + GAUSSIAN_SQL.replace("UNPIVOT shape ON", "UNPIVOT scaled ON").replace(
        "long AS (",
        f"""deviations AS (
            SELECT stddev_samp(n_words) AS a, stddev_samp(avg_word) AS b,
                   stddev_samp(ascii_share) AS c, stddev_samp(mark_share) AS d
            FROM shape WHERE {TRAIN_SQL}
        ), scaled AS (
            SELECT doc_id, lang, n_words / a AS n_words, avg_word / b AS avg_word,
                   ascii_share / c AS ascii_share, mark_share / d AS mark_share
            FROM shape, deviations
        ), long AS (""",
    )
    + ", "
    + _PARTS_SQL.format(train=TRAIN_SQL, predicted="predicted")
)


def _tabular(classifier, scaling=None, **how):
    def run(spark, sf_dir):
        rows = stored_shape(spark, sf_dir)
        plan = TabularPlan("doc_id", SHAPE_COLUMNS, "lang", classifier, scaling, **how)
        scored = plan.score(plan.fit(rows), rows)
        return _rounded(plan.report(scored))

    return run


def _rounded(report):
    return report.withColumn("value", F.round("value", 6))


query("train_lr")(_tabular("lr"))
query("train_lr_scaled")(_tabular("lr", "std"))
query("train_dt")(_tabular("dt"))
query("train_dt_scaled")(_tabular("dt", "std"))
query("train_rf")(_tabular("rf"))
query("train_rf_scaled")(_tabular("rf", "std"))
query("train_rf_components")(_tabular("rf", "pca", trees=10))
query("train_gaussian_nb_scaled", _SCALED_GNB_SQL)(_tabular("gnb", "std"))
query("train_mlp")(_tabular("mlp", "std", max_iter=100))
query("train_ovr")(_tabular("ovr", "std", max_iter=25, reg=0.01))


@query(
    "library_gaussian_predict",
    f"WITH {GAUSSIAN_SQL} SELECT doc_id, lang, prediction FROM predicted",
)
def library_gaussian_predict(spark, sf_dir):
    """Gaussian Bayes as a library stage, with the labels of the fitted indexer."""
    rows = stored_shape(spark, sf_dir)
    plan = TabularPlan("doc_id", SHAPE_COLUMNS, "lang", "gnb")
    scored = plan.score(plan.fit(rows), rows)
    return scored.select("doc_id", "lang", F.col("predicted_label").alias("prediction"))


@query("cross_validate")
def cross_validate(spark, sf_dir):
    """Three folds over five penalties of a one-vs-rest model; the mean metric of each."""
    rows = stored_shape(spark, sf_dir)
    plan = TabularPlan("doc_id", SHAPE_COLUMNS, "lang", "ovr", "std", max_iter=25, reg=0.01)
    regs = [0.0001, 0.001, 0.01, 0.1, 0.5]
    tuned = plan.tune(rows, regs, metric="accuracy")
    scored = plan.score(tuned.bestModel, rows)
    found = [("cv", f"accuracy_reg_{r}", float(m)) for r, m in zip(regs, tuned.avgMetrics)]
    averages = spark.createDataFrame(found, "part string, metric string, value double")
    return _rounded(plan.report(scored).unionByName(averages))


#: Graded documents under the name the language SQL reads, the grade as target.
_GRADED_SQL = """
documents AS (
    SELECT d.doc_id, d.text, l.quality::VARCHAR AS lang
    FROM main.documents d JOIN main.labels l ON l.doc_id = d.doc_id
    WHERE {rows}
)
"""

_TEXT_NB_SQL = (
    "WITH " + _GRADED_SQL.format(rows="true") + f", {fit_sql()}, {PREDICT_SQL}, "
    + _PARTS_SQL.format(train=TRAIN_SQL, predicted="predicted")
)

_IN_RANGE = (
    r"length(text) - length(regexp_replace(text, '[?!]', '', 'g')) <= 10 "
    r"AND length(text) - length(replace(text, chr(10), '')) <= 10 "
    r"AND length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) <= 10"
)
_VOTES_NB_SQL = (
    "WITH " + _GRADED_SQL.format(rows=_IN_RANGE) + f", {FULL_SQL}, "
    "full_predicted AS (SELECT doc_id, lang, label AS prediction FROM full_ranked WHERE place = 1), "
    + _PARTS_SQL.format(train=TRAIN_SQL, predicted="full_predicted")
)

_STEM_NB_SQL = (
    "WITH " + _GRADED_SQL.format(rows="true")
    + f", {WORDS_SQL}, {stem_sql('placed')}, raw_tokens AS ("
    "SELECT p.doc_id, d.lang, s.stem AS term FROM placed p JOIN stems s USING (word) "
    "JOIN documents d ON d.doc_id = p.doc_id"
    f"), tokens AS (SELECT * FROM raw_tokens WHERE term NOT IN {STOP_SQL}), "
    + model_sql(IDF_SQL) + f", {PREDICT_SQL}, "
    + _PARTS_SQL.format(train=TRAIN_SQL, predicted="predicted")
).replace("< 80", "< 70").replace("HAVING count(DISTINCT doc_id) >= 5 ", "").replace("LIMIT 10000", "LIMIT 262144")


def _reviews(spark, sf_dir, plan):
    """Graded documents with three counts and the tokens of their text, written once.

    Texts without a grade go before any work on texts: the grades are two narrow
    columns, sent to the texts while they fit the engine's limit and met by a
    filtered join beyond.  The job reads its rows several times, and on stored
    counts its filters reach the scan.
    """
    grades = table(spark, sf_dir, "labels", "doc_id", "quality").dropna()
    graded = documents(spark, sf_dir).join(grades, "doc_id")
    return materialize(plan.with_tokens(text_votes(graded)), "reviews")


def _review(**how):
    def run(spark, sf_dir):
        plan = ReviewPlan(key="doc_id", target="quality", votes=VOTE_COLUMNS, **how)
        prepared = plan.prepare(_reviews(spark, sf_dir, plan))
        scored = plan.score(plan.fit(prepared), prepared)
        return _rounded(plan.report(scored))

    return run


query("review_lr")(_review(classifier="lr"))
query("review_lr_text")(_review(classifier="lr", feature_set="text"))
query("review_lr_votes")(_review(classifier="lr", feature_set="votes", fit_on="all"))
query("review_dt")(_review(classifier="dt"))
query("review_dt_text")(_review(classifier="dt", feature_set="text"))
#: Stems weighted by rarity, with the library's own vocabulary limits.
_STEMS = {"feature_set": "text", "tokenizer": "stems", "idf": True, "vocab_size": None, "min_df": None}
query("review_stem_tfidf_lr")(_review(classifier="lr", max_iter=10, **_STEMS))
query("review_stem_tfidf_dt")(_review(classifier="dt", train_percent=70, **_STEMS))
query("review_stem_tfidf_nb", _STEM_NB_SQL)(_review(classifier="nb", train_percent=70, **_STEMS))
query("review_nb", _VOTES_NB_SQL)(
    _review(classifier="nb", vote_range=(0, 10), target_range=(-1, 1))
)
query("review_nb_text", _TEXT_NB_SQL)(_review(classifier="nb", feature_set="text"))


def _language_plan(**how):
    return ReviewPlan(
        key="doc_id", target="lang", feature_set="text", classifier="nb", clean=False, **how
    )


def language_models(spark, sf_dir, **how):
    """Feature pipeline and Bayes classifier of the language of a document."""
    plan = _language_plan(**how)
    return plan.fit(plan.prepare(documents(spark, sf_dir, "lang")))


def language_name(models):
    """Predicted language, from the labels of the fitted indexer."""
    labels = models[0].stages[0].labels
    return lookup(F.col("prediction"), {float(i): name for i, name in enumerate(labels)})


def _named(scored, models):
    return scored.select("doc_id", "lang", language_name(models).alias("prediction"))


@query(
    "library_nb_predict",
    f"WITH {TERM_PREDICTION_SQL} SELECT doc_id, lang, prediction, {TRAIN_SQL} AS train FROM predicted",
)
def library_nb_predict(spark, sf_dir):
    """Tokens, stop words, term counts and Bayes as library stages; no shuffle to score."""
    models = language_models(spark, sf_dir)
    scored = chain_models(*models).transform(documents(spark, sf_dir, "lang"))
    train = F.expr("pmod(conv(substring(md5(string(doc_id)), 1, 8), 16, 10)::bigint, 100) < 80")
    return _named(scored, models).withColumn("train", train)


@query(
    "library_tfidf_nb_predict",
    f"WITH {fit_sql(IDF_SQL)}, {PREDICT_SQL} SELECT doc_id, lang, prediction FROM predicted",
)
def library_tfidf_nb_predict(spark, sf_dir):
    models = language_models(spark, sf_dir, idf=True)
    scored = chain_models(*models).transform(documents(spark, sf_dir, "lang"))
    return _named(scored, models)


@query(
    "model_roundtrip",
    f"WITH {TERM_PREDICTION_SQL} SELECT doc_id, lang, prediction FROM predicted",
)
def model_roundtrip(spark, sf_dir):
    """A whole fitted pipeline saved, overwritten, loaded and applied."""
    models = language_models(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_model(chain_models(*models), path)
    save_model(chain_models(*models), path, overwrite=True)
    scored = load_pipeline(path).transform(documents(spark, sf_dir, "lang"))
    return _named(scored, models)


@query(
    "two_artifact_score",
    f"WITH {TERM_PREDICTION_SQL} SELECT doc_id, lang, prediction FROM predicted",
)
def two_artifact_score(spark, sf_dir):
    """Features and classifier saved apart, loaded and applied in turn."""
    models = language_models(spark, sf_dir)
    paths = [scratch_path(spark, "features"), scratch_path(spark, "classifier")]
    for model, path in zip(models, paths):
        save_model(model, path)
    scored = documents(spark, sf_dir, "lang")
    for path in paths:
        scored = load_pipeline(path).transform(scored)
    return _named(scored, models)
