"""Features that need no look-up table of terms, and vector positions that are categories."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorestream.catalog.columns import TRAIN_SQL
from scorestream.catalog.registry import query, table
from scorestream.catalog.text import TOKENS_SQL, documents, words
from scorestream.functions.text import without_words
from scorestream.operators import features, hashed
from scorestream.operators.split import is_train
from scorestream.operators.terms import english_stop_words

_BUCKETS = 4096
_BUCKET_SQL = f"('0x' || substr(md5(term), 1, 8))::BIGINT % {_BUCKETS}"


@query(
    "hashed_term_load",
    f"""
    WITH {TOKENS_SQL}, counts AS (SELECT term, count(*) AS n FROM tokens GROUP BY term)
    SELECT {_BUCKET_SQL} AS bucket, sum(n)::BIGINT AS cf, count(*) AS n_terms, (sum(n) - max(n))::BIGINT AS hidden
    FROM counts GROUP BY 1
    """,
)
def hashed_term_load(spark, sf_dir):
    """What falls into every bucket, and how much of it collides."""
    return hashed.bucket_load(documents(spark, sf_dir), words(), _BUCKETS, english_stop_words())


@query(
    "hashed_nb_predict",
    f"""
    WITH {TOKENS_SQL}, placed AS (
        SELECT doc_id, lang, {_BUCKET_SQL} AS bucket FROM tokens
    ), classes AS (
        SELECT lang AS label, count(*) AS n,
               ln(count(*) + 1.0::DOUBLE) - ln(sum(count(*)) OVER () + count(*) OVER ()) AS log_prior
        FROM documents WHERE {TRAIN_SQL} GROUP BY lang
    ), seen AS (
        SELECT bucket, lang AS label, count(*) AS n FROM placed WHERE {TRAIN_SQL} GROUP BY ALL
    ), totals AS (
        SELECT label, sum(n) AS total FROM seen GROUP BY label
    ), params AS (
        SELECT b.bucket, t.label, ln(coalesce(s.n, 0) + 1.0::DOUBLE) - ln(t.total + {_BUCKETS}) AS log_prob
        FROM range({_BUCKETS}) AS b(bucket) CROSS JOIN totals t
        LEFT JOIN seen s ON s.bucket = b.bucket AND s.label = t.label
    ), scores AS (
        SELECT doc_id, p.label, sum(log_prob) AS s FROM placed JOIN params p USING (bucket) GROUP BY ALL
    )
    SELECT d.doc_id, d.lang, c.label AS prediction
    FROM documents d CROSS JOIN classes c LEFT JOIN scores s ON s.doc_id = d.doc_id AND s.label = c.label
    QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY log_prior + coalesce(s, 0) DESC, c.n DESC, c.label) = 1
    """,
)
def hashed_nb_predict(spark, sf_dir):
    """Language of a document by a model over hashed terms."""
    rows = documents(spark, sf_dir, "lang")
    kept = without_words(words(), english_stop_words())
    model = hashed.fit_hashed(rows.where(is_train("doc_id")), "lang", kept, _BUCKETS)
    return model.predict(rows, "doc_id", hashed.hashed_tokens(kept, _BUCKETS), ["lang"])


_MEASURES = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
_MOST = 12


def _recode_sql() -> str:
    """Codes of every measure by its rank, where its values are few enough."""
    codes = ", ".join(
        f"codes_{c} AS (SELECT {c}, CASE WHEN count(*) OVER () <= {_MOST} "
        f"THEN (row_number() OVER (ORDER BY {c}) - 1)::DOUBLE ELSE {c}::DOUBLE END AS r_{c} "
        f"FROM (SELECT DISTINCT {c} FROM lineitem))"
        for c in _MEASURES
    )
    joins = " ".join(f"JOIN codes_{c} USING ({c})" for c in _MEASURES)
    shown = ", ".join(f"r_{c}" for c in _MEASURES)
    return f"WITH {codes} SELECT {shown}, count(*) AS n FROM lineitem {joins} GROUP BY ALL"


def _recoded(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem", *_MEASURES)
    stages = [features.assemble(_MEASURES), features.recode_categories(most=_MOST)]
    return Pipeline(stages=stages).fit(rows), rows


@query("recoded_positions", _recode_sql())
def recoded_positions(spark, sf_dir):
    """Vectors whose positions of few values became codes; how often each vector occurs."""
    model, rows = _recoded(spark, sf_dir)
    values = vector_to_array(F.col("recoded"))
    named = [values[i].alias(f"r_{c}") for i, c in enumerate(_MEASURES)]
    return model.transform(rows).select(*named).groupBy(*(f"r_{c}" for c in _MEASURES)).agg(F.count("*").alias("n"))


@query(
    "categorical_positions",
    " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS measure, CASE WHEN count(DISTINCT {c}) <= {_MOST} "
        f"THEN count(DISTINCT {c}) END AS n_values FROM lineitem"
        for i, c in enumerate(_MEASURES)
    ),
)
def categorical_positions(spark, sf_dir):
    """Which positions of a vector are categories, and of how many values; null where there are too many."""
    model, rows = _recoded(spark, sf_dir)
    found = model.stages[-1].categoryMaps
    sizes = [(i, c, len(found[i]) if i in found else None) for i, c in enumerate(_MEASURES)]
    return rows.sparkSession.createDataFrame(sizes, "place int, measure string, n_values long")
