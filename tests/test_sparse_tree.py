import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from scorestream.operators import classifiers
from scorestream.operators.sparse_tree import SparseTree
from scorestream.plans.review import ReviewPlan
from scorestream.sources.artifacts import chain_models, load_pipeline, save_model


def _rows(spark, kind, n=600, width=40):
    """Sparse rows; some features have far more values than bins, some are copies of others, some never occur."""
    rng, rows = np.random.default_rng(7), []
    for i in range(n):
        dense = np.zeros(width)
        dense[:20] = rng.poisson(0.3, 20) * (1 + 0.37 * np.arange(20))
        dense[20:24] = np.round(rng.exponential(5, 4) * (rng.random(4) < 0.7), 2)
        dense[24:28] = dense[[3, 20, 3, 21]]
        dense[28:32] = 1.5
        if kind == "signed":
            dense[32:36] = np.round(rng.normal(0, 3, 4) * (rng.random(4) < 0.6), 1)
            dense[36] = -abs(dense[20])
        signal = dense[3] + dense[20] - dense[5] + dense[32] + rng.normal(0, 2)
        held = [(k, float(v)) for k, v in enumerate(dense) if v or i % 2]
        vector = Vectors.sparse(width, held) if i % 50 else Vectors.dense(dense)
        rows.append((i, "abc"[int(signal > 2) + int(signal > 7)], vector))
    df = spark.createDataFrame(rows, ["id", "name", "features"])
    return StringIndexer(inputCol="name", outputCol="label", handleInvalid="keep").fit(df).transform(df)


def _seen(model, df):
    columns = ("id", "prediction", "rawPrediction", "probability")
    return [tuple(map(str, r)) for r in model.transform(df).select(*columns).orderBy("id").collect()]


@pytest.mark.parametrize("kind, depth, bins", [("counts", 4, 32), ("signed", 3, 8), ("signed", 0, 32)])
def test_a_sparse_tree_is_the_library_s_tree(spark, kind, depth, bins):
    df = _rows(spark, kind)
    found, wanted = (tree(maxDepth=depth, maxBins=bins).fit(df) for tree in (SparseTree, DecisionTreeClassifier))
    assert _seen(found, df) == _seen(wanted, df)


def test_a_sparse_tree_of_alike_rows_is_a_leaf(spark):
    df = _rows(spark, "counts").withColumn("label", F.lit(1.0))
    assert {r[1] for r in _seen(SparseTree().fit(df), df)} == {"1.0"}
    with pytest.raises(ValueError, match="at least one row"):
        SparseTree().fit(df.where("id < 0"))


def test_a_wide_review_tree_is_not_grown_on_dense_rows(spark, monkeypatch, tmp_path):
    """The same scores and labels, without a number kept for every term of every row."""
    df = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") * 31 % 17 < 8).cast("int")).alias("stars"),
        F.concat_ws(" ", *(F.concat(F.lit(f"w{k}x"), F.col("id") * (k + 3) % (11 + k)) for k in range(6))).alias("text"),
    )
    plan = ReviewPlan(key="doc_id", min_df=None, vocab_size=None, idf=True, feature_set="text", classifier="dt")
    prepared = plan.prepare(df)
    dense = plan.score(plan.fit(prepared), prepared).orderBy("doc_id").collect()

    def refuse(*_, **__):
        raise AssertionError("dense rows")

    monkeypatch.setattr(classifiers, "_TREE_WIDTH", 20)
    monkeypatch.setattr(classifiers, "dealt_for_trees", refuse)
    monkeypatch.setattr(DecisionTreeClassifier, "fit", refuse)
    models = plan.fit(prepared)
    assert plan.score(models, prepared).orderBy("doc_id").collect() == dense
    assert {r["prediction"] for r in dense} == {0.0, 1.0}

    save_model(chain_models(*models), str(tmp_path / "m"))
    again = load_pipeline(str(tmp_path / "m"))
    assert plan.score([again], prepared).orderBy("doc_id").collect() == dense


def test_candidate_splits_take_all_rows(spark):
    """One row of 12,001 tells the labels apart; a sample of 10,000 may leave it out."""
    df = spark.range(12_001).coalesce(1).select(
        "id",
        F.when(F.col("id") == 12_000, "b").otherwise("a").alias("name"),
        F.udf(lambda i: Vectors.sparse(3, [(1, float(i == 12_000) or 2.0 * (i % 2))]), VectorUDT())("id").alias("features"),
    )
    indexed = Pipeline(stages=[StringIndexer(inputCol="name", outputCol="label")]).fit(df).transform(df)
    scored = SparseTree().fit(indexed).transform(indexed)
    assert [r["id"] for r in scored.where("prediction = 1").select("id").collect()] == [12_000]
