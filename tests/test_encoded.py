"""Hashed terms, recoded vector positions, nested trees, one pass for several models."""

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorestream.catalog.exact import _nested_sql
from scorestream.functions.text import word_tokens
from scorestream.operators import classifiers, features, hashed, metrics, terms
from scorestream.operators.naive_bayes import TermNaiveBayes, predict_each
from scorestream.operators.split import is_train
from scorestream.plans.review import ReviewPlan
from scorestream.streaming.scoring import score_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").repartition(4).cache()


def words():
    return word_tokens(F.col("text"))


def share(predicted):
    return metrics.evaluate(predicted, "lang").first().accuracy


def test_load_of_few_buckets(spark):
    df = spark.createDataFrame([(["a", "a", "b", "c"],), (["a"],), ([],), (None,)], "w array<string>")
    one = hashed.bucket_load(df, F.col("w"), 1).collect()
    assert [tuple(r) for r in one] == [(0, 5, 3, 2)]
    many = hashed.bucket_load(df, F.col("w"), 2**31 - 1).collect()
    assert sorted(r.cf for r in many) == [1, 1, 3] and all(r.hidden == 0 for r in many)
    assert hashed.bucket_load(df.limit(0), F.col("w"), 8).count() == 0


def test_hashed_model_is_nearly_as_good_as_the_vocabulary(spark, documents):
    train = documents.where(is_train("doc_id"))
    held = documents.where(~is_train("doc_id"))
    by_term = TermNaiveBayes.fit(train, "lang", words())
    by_hash = hashed.fit_hashed(train, "lang", words(), 2048)
    assert by_hash.terms.count() == 2048
    guessed = by_hash.predict(held, "doc_id", hashed.hashed_tokens(words(), 2048), ["lang"])
    assert share(guessed) >= share(by_term.predict(held, "doc_id", words(), ["lang"])) - 0.05


def test_probabilities_over_all_buckets_sum_to_one(spark):
    df = spark.createDataFrame([("x", ["a", "b"]), ("y", None), ("x", []), (None, ["a"])], "lang string, w array<string>")
    model = hashed.fit_hashed(df, "lang", F.col("w"), 64)
    sums = model.parameters().groupBy("label").agg(F.sum(F.exp("log_prob")).alias("s")).collect()
    assert {r.label for r in sums} == {"x", "y"} and all(abs(r.s - 1) < 1e-9 for r in sums)


def test_hashed_stage_learns_nothing_and_serves_a_stream(spark, documents, tmp_path):
    plan = ReviewPlan(key="doc_id", target="lang", feature_set="text", classifier="nb", clean=False, buckets=4096)
    models = plan.fit(documents)
    scored = plan.score(models, documents)
    assert share(scored.join(documents, "doc_id").withColumn("prediction", F.col("prediction")).select(
        F.col("label").alias("lang"), "prediction"
    )) > 0.9
    folder = str(tmp_path / "in")
    documents.select("doc_id", "lang", "text").write.json(folder)
    stream = spark.readStream.schema("doc_id long, lang string, text string").json(folder)
    running = (
        score_stream(stream, *models).select("doc_id", "prediction").writeStream.format("memory")
        .queryName("hashed_scores").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    batch = {r.doc_id: r.prediction for r in scored.collect()}
    assert {r.doc_id: r.prediction for r in spark.table("hashed_scores").collect()} == batch


def test_recoded_positions_with_negatives_and_unseen_values(spark):
    rows = [(-3.0, 0.5), (0.0, 1.5), (7.0, 2.5), (-3.0, 3.5)]
    df = spark.createDataFrame(rows, "a double, b double")
    stages = [features.assemble(["a", "b"]), features.recode_categories(most=3, invalid="keep")]
    model = Pipeline(stages=stages).fit(df)
    unseen = spark.createDataFrame([*rows, (1.0, 9.5)], "a double, b double")
    codes = model.transform(unseen).select("a", "b", vector_to_array("recoded").alias("v")).collect()
    seen = {(r.a, r.b): tuple(r.v) for r in codes}
    # Zero has code 0, then rising; a value not seen is one more code; b has four values and stays.
    assert seen == {(-3.0, 0.5): (1.0, 0.5), (0.0, 1.5): (0.0, 1.5), (7.0, 2.5): (2.0, 2.5),
                    (-3.0, 3.5): (1.0, 3.5), (1.0, 9.5): (3.0, 9.5)}


def test_nested_tree_needs_its_depth(spark):
    """The SQL of one, two and three levels differ on the given documents, so depth is put to the test."""
    base = duckdb.connect()
    base.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    answers = [sorted(base.sql(_nested_sql(depth)).fetchall()) for depth in (1, 2, 3)]
    assert answers[0] != answers[1] != answers[2]


def test_tree_without_a_useful_cut_is_one_leaf(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 1.0), (1.0, 0.0)], "x double, label double")
    model = Pipeline(stages=[features.assemble(["x"]), classifiers.decision_tree(maxDepth=3)]).fit(df)
    assert model.stages[-1].depth == 0
    assert {r.prediction for r in model.transform(df).collect()} == {0.0}


def test_several_models_in_one_pass_equal_each_alone(spark, documents):
    rows = features.text_votes(documents)
    full = TermNaiveBayes.fit(rows, "lang", words(), numeric=features.VOTE_COLUMNS)
    text = full.without_numeric()
    both = predict_each({"text": text, "full": full}, rows, "doc_id", words(), ["lang"])
    got = {r.doc_id: (r.text, r.full) for r in both.collect()}
    alone = [{r.doc_id: r.prediction for r in m.predict(rows, "doc_id", words()).collect()} for m in (text, full)]
    assert got == {k: (alone[0][k], alone[1][k]) for k in got}
    assert {r.prediction for r in TermNaiveBayes.fit(rows, "lang", words()).predict(rows, "doc_id", words()).collect()}
    with pytest.raises(ValueError):
        predict_each({"a": full, "b": TermNaiveBayes.fit(rows, "lang", words())}, rows, "doc_id", words())


def test_both_ways_to_weigh_terms_agree(spark, monkeypatch):
    rows = [(1, ["a", "b", "a", "the"]), (2, []), (3, None), (4, ["zzz"]), (5, ["b", None])]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    idf = spark.createDataFrame([("a", 2.0), ("b", 0.5), ("the", 1.0), ("none", 3.0)], "term string, idf double")
    expected = {(1, "a", 2, 4.0), (1, "b", 1, 0.5), (5, "b", 1, 0.5)}
    for most in (terms.MODEL_TERMS, 0):
        monkeypatch.setattr(terms, "MODEL_TERMS", most)
        got = terms.term_weights(df, "id", F.col("w"), idf, ["the"]).collect()
        assert {(r.id, r.term, r.tf, r.tfidf) for r in got} == expected and len(got) == 3
