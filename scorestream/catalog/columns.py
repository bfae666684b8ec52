"""Projections, cleaning, labels, splits and numeric features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorestream.catalog.registry import query, table
from scorestream.functions.labels import branch_code, correct_flag, lookup, percent_text
from scorestream.functions.numeric import vote_interactions, with_interactions
from scorestream.operators import clean, features, project
from scorestream.operators.split import hash_bucket, is_train
from scorestream.workspace import materialize, spread

#: The split rule in SQL.
TRAIN_SQL = "(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100) < 80"

#: The four measurements of a text in SQL, as a CTE named shape.
SHAPE_SQL = r"""
squeezed AS (
    SELECT doc_id, lang, text, length(text) AS n, trim(regexp_replace(text, '\s+', ' ', 'g')) AS s
    FROM documents
), counted AS (
    SELECT *, length(s) - length(replace(s, ' ', '')) AS blanks FROM squeezed
), shape AS (
    SELECT doc_id, lang,
        CASE WHEN length(s) > 0 THEN blanks + 1 ELSE 0 END::DOUBLE AS n_words,
        CASE WHEN length(s) > 0 THEN (length(s) - blanks)::DOUBLE / (blanks + 1) ELSE 0 END AS avg_word,
        CASE WHEN n > 0 THEN length(regexp_replace(text, '[^\x00-\x7F]', '', 'g'))::DOUBLE / n ELSE 1 END AS ascii_share,
        CASE WHEN n > 0 THEN (n - length(regexp_replace(text, '[.,;:!?]', '', 'g')))::DOUBLE / n ELSE 0 END AS mark_share
    FROM counted
)
"""


def document_shape(spark, sf_dir):
    """Four measurements per document; the text is dropped before any shuffle."""
    documents = spread(table(spark, sf_dir, "documents", "doc_id", "lang", "text"))
    return features.text_shape(documents).drop("text")


def stored_shape(spark, sf_dir):
    """The measurements, written once for jobs that read them more than once.

    They are a small fraction of the texts, which are then scanned only once.
    """
    return materialize(document_shape(spark, sf_dir), "shape")


@query(
    "project_rename_cast",
    """
    SELECT o_orderkey::VARCHAR AS code, o_custkey AS cust, o_orderstatus AS label,
           trunc(o_totalprice)::INTEGER AS total, NULL::DOUBLE AS unfit
    FROM orders
    """,
)
def project_rename_cast(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    named = project.rename_all(orders, "code", "cust", "status", "price")
    copied = project.copy_column(named, "status", "label")
    renamed = project.rename(project.rename(copied, "price", "total"), "absent", "ignored")
    copied = project.copy_column(renamed, "status", "unfit")
    cast = project.cast_nullable(copied, {"code": "string", "total": "int", "unfit": "double"})
    return cast.select(project.columns_without(cast, "status"))


@query(
    "filter_ranges",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity > 0 AND l_quantity <= 25 AND l_linenumber BETWEEN 0 AND 10
      AND l_quantity BETWEEN 0 AND 10 AND l_discount BETWEEN 0 AND 10
    """,
)
def filter_ranges(spark, sf_dir):
    columns = ("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    lines = table(spark, sf_dir, "lineitem", *columns)
    target = clean.above_up_to("l_quantity", 0, 25)
    return lines.where(target & clean.all_between(columns[1:], 0, 10))


def _messy_parts(spark, sf_dir):
    """Parts with blanks, NaN text and NaN numbers put in by value."""
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice", "p_size")
    return part.select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_brand") == "Brand#1", F.lit("   ")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("NaN")).otherwise(F.col("p_type")).alias("p_type"),
        F.when(F.col("p_size") == 7, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("p_retailprice"),
    )


@query(
    "clean_to_null_dropna",
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part
    WHERE p_brand <> 'Brand#1' AND p_type <> 'ECONOMY' AND p_size <> 7
    """,
)
def clean_to_null_dropna(spark, sf_dir):
    return clean.clean_rows(_messy_parts(spark, sf_dir))


@query(
    "null_profile",
    """
    SELECT 'p_partkey' AS "column", 0::BIGINT AS n_null
    UNION ALL SELECT 'p_name', 0
    UNION ALL SELECT 'p_brand', count(*) FILTER (WHERE p_brand = 'Brand#1') FROM part
    UNION ALL SELECT 'p_type', count(*) FILTER (WHERE p_type = 'ECONOMY') FROM part
    UNION ALL SELECT 'p_retailprice', count(*) FILTER (WHERE p_size = 7) FROM part
    """,
)
def null_profile(spark, sf_dir):
    return clean.null_profile(clean.blanks_to_null(_messy_parts(spark, sf_dir)))


def _int_or_null(expression: str) -> str:
    return f"CASE WHEN {expression} <= 2147483647 THEN ({expression})::INTEGER END"


_CUS = "o_custkey::HUGEINT"
_ORD = "o_orderkey::HUGEINT"
_PRC = "trunc(o_totalprice)::HUGEINT"


@query(
    "interaction_features",
    f"""
    SELECT o_orderkey, {_int_or_null(f'{_CUS} * {_ORD}')} AS cool_useful,
           {_int_or_null(f'{_CUS} * {_PRC}')} AS cool_funny,
           {_int_or_null(f'{_PRC} * {_ORD}')} AS funny_useful,
           CASE WHEN {_CUS} * {_PRC} <= 2147483647 THEN
                {_int_or_null(f'{_CUS} * {_PRC} * {_ORD}')} END AS cool_useful_funny
    FROM orders
    """,
)
def interaction_features(spark, sf_dir):
    """Products of integer counts; null where the product leaves the range."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    counts = orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("cool"),
        F.col("o_orderkey").cast("int").alias("useful"),
        F.col("o_totalprice").cast("int").alias("funny"),
    )
    terms = vote_interactions("cool", "useful", "funny")
    return with_interactions(counts, terms).select("o_orderkey", *terms)


_RANKED_SQL = """
    ranked AS (
        SELECT o_orderpriority AS label,
               (row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1)::DOUBLE AS code
        FROM orders GROUP BY o_orderpriority
    )
"""


def _priority_indexer(orders):
    return features.index_label("o_orderpriority", "code").fit(orders)


@query(
    "label_encode_map",
    f"WITH {_RANKED_SQL} SELECT o_orderkey, code FROM orders JOIN ranked ON label = o_orderpriority",
)
def label_encode_map(spark, sf_dir):
    """Label to code by a literal map whose codes come from the fitted indexer."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    labels = _priority_indexer(orders).labels
    codes = {label: float(i) for i, label in enumerate(labels)}
    return orders.select("o_orderkey", lookup(F.col("o_orderpriority"), codes).alias("code"))


@query(
    "label_decode_map",
    f"""
    WITH {_RANKED_SQL}
    SELECT l_orderkey, l_linenumber, l_quantity, label
    FROM lineitem LEFT JOIN ranked ON code = l_linenumber::DOUBLE
    """,
)
def label_decode_map(spark, sf_dir):
    """Code to label by a literal map; a code without a label gives null."""
    labels = _priority_indexer(table(spark, sf_dir, "orders", "o_orderpriority")).labels
    names = {float(i): label for i, label in enumerate(labels)}
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    code = F.col("l_linenumber").cast("double")
    return lines.withColumn("label", lookup(code, names))


@query(
    "label_branches",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS code
    FROM orders
    """,
)
def label_branches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    code = branch_code(F.col("o_orderstatus"), {"F": 1, "O": 2}, default=0)
    return orders.select("o_orderkey", code.alias("code"))


@query(
    "index_roundtrip",
    f"""
    WITH {_RANKED_SQL}
    SELECT o_orderkey, code, o_orderpriority AS back FROM orders JOIN ranked ON label = o_orderpriority
    """,
)
def index_roundtrip(spark, sf_dir):
    """Labels to codes and back with the labels of the fitted indexer."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    indexer = _priority_indexer(orders)
    back = features.unindex_label(indexer.labels, "code", "back")
    return back.transform(indexer.transform(orders)).select("o_orderkey", "code", "back")


@query(
    "correct_flag_accuracy",
    """
    WITH flagged AS (
        SELECT l_linenumber, l_returnflag AS label,
               CASE WHEN l_linestatus = 'O' THEN 'N' WHEN l_discount > 0.05 THEN 'A' ELSE 'R' END AS guess
        FROM lineitem
    )
    SELECT l_linenumber, count(*) AS n_rows,
           sum(CASE WHEN guess = label THEN 1 ELSE 0 END)::BIGINT AS n_correct,
           format('{:,.2f}', avg(CASE WHEN guess = label AND label IN ('A', 'N') THEN 1 ELSE 0 END) * 100) AS accuracy
    FROM flagged GROUP BY l_linenumber
    """,
)
def correct_flag_accuracy(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount")
    guess = (
        F.when(F.col("l_linestatus") == "O", F.lit("N"))
        .when(F.col("l_discount") > 0.05, F.lit("A"))
        .otherwise(F.lit("R"))
    )
    label = F.col("l_returnflag")
    return (
        lines.withColumn("guess", guess)
        .groupBy("l_linenumber")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(correct_flag(F.col("guess"), label)).alias("n_correct"),
            percent_text(correct_flag(F.col("guess"), label, ["A", "N"])).alias("accuracy"),
        )
    )


@query(
    "hash_split",
    f"""
    SELECT doc_id, (('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100) AS bucket,
           {TRAIN_SQL} AS train
    FROM documents
    """,
)
def hash_split(spark, sf_dir):
    documents = table(spark, sf_dir, "documents", "doc_id")
    return documents.select(
        "doc_id", hash_bucket("doc_id").alias("bucket"), is_train("doc_id").alias("train")
    )


def _vector_columns(df, vector, digits=9):
    array = vector_to_array(F.col(vector))
    return [F.round(array[i], digits).alias(f"f{i}") for i in range(4)]


@query(
    "assemble_features",
    f"""
    WITH {SHAPE_SQL}
    SELECT doc_id, round(n_words, 9) AS f0, round(avg_word, 9) AS f1, round(ascii_share, 9) AS f2,
           round(mark_share, 9) AS f3
    FROM shape
    """,
)
def assemble_features(spark, sf_dir):
    rows = document_shape(spark, sf_dir)
    vectors = Pipeline(stages=[features.assemble(features.SHAPE_COLUMNS)]).fit(rows).transform(rows)
    return vectors.select("doc_id", *_vector_columns(vectors, "features"))


def _scaled(spark, sf_dir, **how):
    rows = stored_shape(spark, sf_dir)
    stages = [features.assemble(features.SHAPE_COLUMNS), features.scale(**how)]
    vectors = Pipeline(stages=stages).fit(rows).transform(rows)
    return vectors.select("doc_id", *_vector_columns(vectors, "scaled", 6))


@query(
    "scale_std",
    f"""
    WITH {SHAPE_SQL}, spread AS (
        SELECT stddev_samp(n_words) AS a, stddev_samp(avg_word) AS b,
               stddev_samp(ascii_share) AS c, stddev_samp(mark_share) AS d
        FROM shape
    )
    SELECT doc_id, round(n_words / a, 6) AS f0, round(avg_word / b, 6) AS f1,
           round(ascii_share / c, 6) AS f2, round(mark_share / d, 6) AS f3
    FROM shape, spread
    """,
)
def scale_std(spark, sf_dir):
    return _scaled(spark, sf_dir, std=True, mean=False)


@query(
    "center_mean",
    f"""
    WITH {SHAPE_SQL}, middle AS (
        SELECT avg(n_words) AS a, avg(avg_word) AS b, avg(ascii_share) AS c, avg(mark_share) AS d
        FROM shape
    )
    SELECT doc_id, round(n_words - a, 6) AS f0, round(avg_word - b, 6) AS f1,
           round(ascii_share - c, 6) AS f2, round(mark_share - d, 6) AS f3
    FROM shape, middle
    """,
)
def center_mean(spark, sf_dir):
    return _scaled(spark, sf_dir, std=False, mean=True)


@query("pca_variance")
def pca_variance(spark, sf_dir):
    """Share of variance and loadings of three components of the centred features."""
    rows = stored_shape(spark, sf_dir)
    stages = [
        features.assemble(features.SHAPE_COLUMNS),
        features.scale(std=False, mean=True),
        features.principal_components(3, "scaled"),
    ]
    vectors = Pipeline(stages=stages).fit(rows).transform(rows)
    values = vector_to_array(F.col("components"))
    measured = vectors.select(*(values[i].alias(f"c{i}") for i in range(3)))
    return measured.agg(
        *(F.round(F.var_samp(f"c{i}"), 6).alias(f"variance_{i}") for i in range(3))
    )
