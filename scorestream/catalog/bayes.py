"""Naive Bayes from grouped statistics, and what is measured on its predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorestream.catalog.columns import SHAPE_SQL, TRAIN_SQL, document_shape, stored_shape
from scorestream.catalog.registry import query
from scorestream.catalog.text import TOKENS_SQL, documents, words
from scorestream.operators import metrics
from scorestream.operators.features import SHAPE_COLUMNS, VOTE_COLUMNS, text_votes
from scorestream.operators.naive_bayes import GaussianNaiveBayes, TermNaiveBayes, predict_each
from scorestream.operators.split import is_train
from scorestream.operators.terms import english_stop_words
from scorestream.functions.numeric import real_product, vote_interactions, with_interactions

#: Multinomial model of the language of a document, fitted on the training rows.
#: CTEs: classes, vocab, idf, params (term, label, log_prob).
_FIT_SQL = f"""
classes AS (
    SELECT lang AS label, count(*) AS n,
           ln(count(*) + 1.0::DOUBLE) - ln((SELECT count(*) FROM documents WHERE {TRAIN_SQL})
               + (SELECT count(DISTINCT lang) FROM documents WHERE {TRAIN_SQL})) AS log_prior
    FROM documents WHERE {TRAIN_SQL} GROUP BY lang
), fitted AS (
    SELECT * FROM tokens WHERE {TRAIN_SQL}
), vocab AS (
    SELECT term, count(DISTINCT doc_id) AS df FROM fitted GROUP BY term
    HAVING count(DISTINCT doc_id) >= 5 ORDER BY count(*) DESC, term LIMIT 10000
), weight AS (
    SELECT term, {{weight}} AS idf FROM vocab
), seen AS (
    SELECT term, lang AS label, count(*) * any_value(idf) AS n
    FROM fitted JOIN weight USING (term) GROUP BY term, lang
), totals AS (
    SELECT label, sum(n) AS total FROM seen GROUP BY label
), params AS (
    SELECT v.term, c.label, v.idf,
           ln(coalesce(s.n, 0) + 1.0::DOUBLE) - ln(t.total + (SELECT count(*) FROM vocab)) AS log_prob
    FROM weight v CROSS JOIN classes c JOIN totals t ON t.label = c.label
    LEFT JOIN seen s ON s.term = v.term AND s.label = c.label
)
"""
IDF_SQL = (
    f"ln(((SELECT count(*) FROM documents WHERE {TRAIN_SQL}) + 1.0::DOUBLE) / (df + 1))"
)

#: One row per document: the label with the highest score.
PREDICT_SQL = """
scores AS (
    SELECT r.doc_id, p.label, sum(p.log_prob * p.idf) AS s
    FROM raw_tokens r JOIN params p USING (term) GROUP BY r.doc_id, p.label
), ranked AS (
    SELECT d.doc_id, d.lang, c.label,
           row_number() OVER (PARTITION BY d.doc_id
               ORDER BY c.log_prior + coalesce(s.s, 0) DESC, c.n DESC, c.label) AS place
    FROM documents d CROSS JOIN classes c
    LEFT JOIN scores s ON s.doc_id = d.doc_id AND s.label = c.label
), predicted AS (
    SELECT doc_id, lang, label AS prediction FROM ranked WHERE place = 1
)
"""


def model_sql(weight: str = "1.0::DOUBLE") -> str:
    """The fit over CTEs named documents, raw_tokens and tokens."""
    return _FIT_SQL.replace("{weight}", weight)


def fit_sql(weight: str = "1.0::DOUBLE") -> str:
    return f"{TOKENS_SQL}, {model_sql(weight)}"


#: Shared with the queries that score the same model through the library.
TERM_PREDICTION_SQL = f"{fit_sql()}, {PREDICT_SQL}"


def fit_terms(spark, sf_dir, **how):
    train = documents(spark, sf_dir, "lang").where(is_train("doc_id"))
    return TermNaiveBayes.fit(train, "lang", words(), english_stop_words(), **how)


def predict_terms(spark, sf_dir, **how):
    model = fit_terms(spark, sf_dir, **how)
    return model.predict(documents(spark, sf_dir, "lang"), "doc_id", words(), ["lang"])


@query(
    "nb_multinomial_params",
    f"WITH {fit_sql()} SELECT term, label, round(log_prob, 9) AS log_prob FROM params",
)
def nb_multinomial_params(spark, sf_dir):
    rows = fit_terms(spark, sf_dir).parameters()
    return rows.select("term", "label", F.round("log_prob", 9).alias("log_prob"))


@query(
    "nb_multinomial_predict",
    f"WITH {TERM_PREDICTION_SQL} SELECT doc_id, lang, prediction, {TRAIN_SQL} AS train FROM predicted",
)
def nb_multinomial_predict(spark, sf_dir):
    return predict_terms(spark, sf_dir).withColumn("train", is_train("doc_id"))


_CONFUSION_SQL = "SELECT lang AS label, prediction, count(*) AS n FROM predicted GROUP BY 1, 2"

#: Metrics in SQL over a CTE named confusion (label, prediction, n).
_METRICS_SQL = """
sides AS (
    SELECT class, sum(support) AS support, sum(guessed) AS guessed, sum(hit) AS hit FROM (
        SELECT label AS class, n AS support, 0 AS guessed,
               CASE WHEN label = prediction THEN n ELSE 0 END AS hit FROM confusion
        UNION ALL SELECT prediction, 0, n, 0 FROM confusion
    ) GROUP BY class
), measured AS (
    SELECT sum(support)::BIGINT AS n_rows, sum(hit)::DOUBLE / sum(support) AS accuracy,
           sum(support * (2.0::DOUBLE * hit / (support + guessed))) / sum(support) AS weighted_f1
    FROM sides
)
"""


@query(
    "language_quality",
    f"""
    WITH {TERM_PREDICTION_SQL}, confusion AS (
        SELECT lang AS label, prediction, count(*) AS n FROM predicted
        WHERE NOT ({TRAIN_SQL}) GROUP BY 1, 2
    ), {_METRICS_SQL}
    SELECT n_rows, round(accuracy, 9) AS accuracy, round(weighted_f1, 9) AS weighted_f1,
           round(1 - accuracy, 9) AS error_rate
    FROM measured
    """,
)
def language_quality(spark, sf_dir):
    """Held-out quality of the language model: scan, split, fit, score, measure."""
    model = fit_terms(spark, sf_dir)
    held_out = documents(spark, sf_dir, "lang").where(~is_train("doc_id"))
    predicted = model.predict(held_out, "doc_id", words(), ["lang"])
    return _rounded(metrics.evaluate(predicted, "lang"))


def _rounded(summary):
    return summary.select("n_rows", *(F.round(c, 9).alias(c) for c in metrics.RATES))


@query(
    "tfidf_nb_predict",
    f"WITH {fit_sql(IDF_SQL)}, {PREDICT_SQL} SELECT doc_id, lang, prediction FROM predicted",
)
def tfidf_nb_predict(spark, sf_dir):
    """The same model over tf-idf weights."""
    return predict_terms(spark, sf_dir, use_idf=True)


_VOTES_SQL = r"""
votes AS (
    SELECT doc_id, lang,
        length(text) - length(regexp_replace(text, '[?!]', '', 'g')) AS funny,
        length(text) - length(replace(text, chr(10), '')) AS useful,
        length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS cool
    FROM documents
), wide AS (
    SELECT *, funny * useful AS funny_useful, funny * cool AS funny_cool, cool * useful AS cool_useful,
           funny * cool * useful AS funny_useful_cool
    FROM votes
), numbers AS (
    UNPIVOT wide ON funny, useful, cool, funny_useful, funny_cool, cool_useful, funny_useful_cool
    INTO NAME feature VALUE x
)
"""
#: The model over terms, counts and products, as a CTE named full_ranked.
FULL_SQL = f"""
{fit_sql()}, {PREDICT_SQL}, {_VOTES_SQL},
number_seen AS (
    SELECT feature, lang AS label, sum(x) AS n FROM numbers WHERE {TRAIN_SQL} GROUP BY 1, 2
), number_totals AS (
    SELECT label, sum(n) AS total FROM number_seen GROUP BY 1
), both_totals AS (
    SELECT c.label, t.total + n.total AS total, (SELECT count(*) FROM vocab) + 7 AS size
    FROM classes c JOIN totals t ON t.label = c.label JOIN number_totals n ON n.label = c.label
), parts AS (
    SELECT r.doc_id, c.label, ln(coalesce(s.n, 0) + 1.0::DOUBLE) - ln(b.total + b.size) AS s
    FROM raw_tokens r JOIN vocab v ON v.term = r.term CROSS JOIN classes c
    JOIN both_totals b ON b.label = c.label
    LEFT JOIN seen s ON s.term = r.term AND s.label = c.label
    UNION ALL
    SELECT m.doc_id, c.label, m.x * (ln(s.n + 1.0::DOUBLE) - ln(b.total + b.size))
    FROM numbers m CROSS JOIN classes c JOIN both_totals b ON b.label = c.label
    JOIN number_seen s ON s.feature = m.feature AND s.label = c.label
), full_ranked AS (
    SELECT d.doc_id, d.lang, c.label,
           row_number() OVER (PARTITION BY d.doc_id
               ORDER BY c.log_prior + coalesce(s.s, 0) DESC, c.n DESC, c.label) AS place
    FROM documents d CROSS JOIN classes c
    LEFT JOIN (SELECT doc_id, label, sum(s) AS s FROM parts GROUP BY 1, 2) s
        ON s.doc_id = d.doc_id AND s.label = c.label
)
"""
_ABLATION_SQL = f"""
{FULL_SQL}, outcomes AS (
    SELECT 'text' AS feature_set, lang AS label, prediction, doc_id FROM predicted
    UNION ALL SELECT 'full', lang, label, doc_id FROM full_ranked WHERE place = 1
)
SELECT feature_set, {TRAIN_SQL} AS train, label, prediction, count(*) AS n
FROM outcomes GROUP BY ALL
"""


@query("ablation_nb", "WITH " + _ABLATION_SQL)
def ablation_nb(spark, sf_dir):
    """One job with term features only, and with counts and their products too; one fit, one pass."""
    rows = text_votes(documents(spark, sf_dir, "lang"))
    terms = vote_interactions(*VOTE_COLUMNS)
    rows = with_interactions(rows, terms, real_product)
    train = rows.where(is_train("doc_id"))
    full = TermNaiveBayes.fit(train, "lang", words(), english_stop_words(), numeric=[*VOTE_COLUMNS, *terms])
    models = {"text": full.without_numeric(), "full": full}
    predicted = predict_each(models, rows, "doc_id", words(), ["lang"])
    both = predicted.withColumn("train", is_train("doc_id")).unpivot(
        ["lang", "train"], list(models), "feature_set", "prediction"
    )
    return metrics.confusion(both, "lang", by=["feature_set", "train"])


#: Gaussian model of the language from four measurements.
#: CTEs: moments (label, feature, mean, variance, log_prior), predicted.
GAUSSIAN_SQL = f"""
{SHAPE_SQL}, long AS (
    UNPIVOT shape ON n_words, avg_word, ascii_share, mark_share INTO NAME feature VALUE x
), train AS (
    SELECT * FROM long WHERE {TRAIN_SQL}
), epsilon AS (
    SELECT 1e-9 * max(v) AS e FROM (SELECT var_pop(x) AS v FROM train GROUP BY feature)
), moments AS (
    SELECT lang AS label, feature, avg(x) AS mean, var_pop(x) + (SELECT e FROM epsilon) AS variance,
           ln(count(*)::DOUBLE) - ln((SELECT count(*) FROM documents WHERE {TRAIN_SQL})) AS log_prior,
           count(*) AS n
    FROM train GROUP BY lang, feature
), gaussian_scores AS (
    SELECT l.doc_id, l.lang, m.label, any_value(m.n) AS n,
           any_value(log_prior) - 0.5 * sum(ln(2 * pi() * variance) + (x - mean) * (x - mean) / variance) AS s
    FROM long l CROSS JOIN moments m WHERE l.feature = m.feature GROUP BY 1, 2, 3
), predicted AS (
    SELECT doc_id, lang, label AS prediction FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, n DESC, label) AS place
        FROM gaussian_scores
    ) WHERE place = 1
)
"""


def fit_shape(rows):
    return GaussianNaiveBayes.fit(rows.where(is_train("doc_id")), "lang", SHAPE_COLUMNS)


def predict_shape(spark, sf_dir):
    rows = stored_shape(spark, sf_dir)
    return fit_shape(rows).predict(rows).select("doc_id", "lang", "prediction")


@query(
    "nb_gaussian_params",
    f"""
    WITH {GAUSSIAN_SQL}
    SELECT label, feature, round(mean, 6) AS mean, round(variance, 6) AS variance,
           round(log_prior, 9) AS log_prior
    FROM moments
    """,
)
def nb_gaussian_params(spark, sf_dir):
    rows = document_shape(spark, sf_dir)
    return fit_shape(rows).parameters(rows).select(
        "label",
        "feature",
        F.round("mean", 6).alias("mean"),
        F.round("variance", 6).alias("variance"),
        F.round("log_prior", 9).alias("log_prior"),
    )


@query(
    "nb_gaussian_predict",
    f"WITH {GAUSSIAN_SQL} SELECT doc_id, lang, prediction FROM predicted",
)
def nb_gaussian_predict(spark, sf_dir):
    return predict_shape(spark, sf_dir)


@query("confusion", f"WITH {GAUSSIAN_SQL} {_CONFUSION_SQL}")
def confusion(spark, sf_dir):
    return metrics.confusion(predict_shape(spark, sf_dir), "lang")


_MEASURED_SQL = f"WITH {GAUSSIAN_SQL}, confusion AS ({_CONFUSION_SQL}), {_METRICS_SQL}"


def _measured(spark, sf_dir):
    return _rounded(metrics.evaluate(predict_shape(spark, sf_dir), "lang"))


@query("accuracy", f"{_MEASURED_SQL} SELECT n_rows, round(accuracy, 9) AS accuracy FROM measured")
def accuracy(spark, sf_dir):
    return _measured(spark, sf_dir).select("n_rows", "accuracy")


@query("weighted_f1", f"{_MEASURED_SQL} SELECT round(weighted_f1, 9) AS weighted_f1 FROM measured")
def weighted_f1(spark, sf_dir):
    return _measured(spark, sf_dir).select("weighted_f1")


@query("error_rate", f"{_MEASURED_SQL} SELECT round(1 - accuracy, 9) AS error_rate FROM measured")
def error_rate(spark, sf_dir):
    return _measured(spark, sf_dir).select("error_rate")


@query(
    "metrics_long",
    f"""
    WITH {GAUSSIAN_SQL}, confusion AS ({_CONFUSION_SQL}), {_METRICS_SQL}
    SELECT 'n_rows' AS metric, n_rows::DOUBLE AS value FROM measured
    UNION ALL SELECT 'accuracy', round(accuracy * 100, 6) FROM measured
    UNION ALL SELECT 'weighted_f1', round(weighted_f1 * 100, 6) FROM measured
    UNION ALL SELECT 'error_rate', round((1 - accuracy) * 100, 6) FROM measured
    """,
)
def metrics_long(spark, sf_dir):
    """Every metric as a row, as percentages."""
    summary = metrics.evaluate(predict_shape(spark, sf_dir), "lang")
    rows = metrics.metrics_long(summary, scale=100.0)
    return rows.select("metric", F.round("value", 6).alias("value"))
