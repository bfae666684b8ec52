import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from scorestream.functions.text import word_tokens
from scorestream.operators import classifiers, features, metrics, terms
from scorestream.operators.naive_bayes import GaussianNaiveBayes, TermNaiveBayes
from scorestream.operators.split import is_train
from scorestream.plans.review import ReviewPlan
from scorestream.plans.tabular import TabularPlan
from scorestream.sources import artifacts
from scorestream.workspace import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    return df.repartition(4, "doc_id").cache()


@pytest.fixture(scope="module")
def shapes(documents):
    return materialize(features.text_shape(documents).drop("text"), "shape")


def words():
    return word_tokens(F.col("text"))


def test_metrics_equal_the_evaluator(spark):
    rows = [(float(i % 3), float((i * 7 // 5) % 4)) for i in range(50)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    mine = metrics.evaluate(df).first()
    for ours, name in (("accuracy", "accuracy"), ("weighted_f1", "f1")):
        assert math.isclose(mine[ours], classifiers.evaluator(name).evaluate(df), abs_tol=1e-12)
    assert mine.n_rows == 50 and math.isclose(mine.error_rate, 1 - mine.accuracy)


def test_metrics_of_no_rows_are_null(spark):
    df = spark.createDataFrame([], "label double, prediction double")
    assert tuple(metrics.evaluate(df).first()) == (0, None, None, None)
    rows = metrics.batch_metrics(df, 3, "label").collect()
    assert {r.metric: r.value for r in rows} == {
        "n_rows": 0.0, "accuracy": None, "weighted_f1": None, "error_rate": None
    }


def test_metrics_by_group_and_scale(spark):
    rows = [("a", 1, 1), ("a", 0, 1), ("b", 1, 1)]
    df = spark.createDataFrame(rows, "part string, label int, prediction int")
    long = metrics.metrics_long(metrics.evaluate(df, by=["part"]), ["part"], scale=100.0)
    got = {(r.part, r.metric): r.value for r in long.collect()}
    assert got[("a", "accuracy")] == 50.0 and got[("b", "weighted_f1")] == 100.0
    assert got[("a", "n_rows")] == 2.0


def test_term_statistics_equal_a_brute_force_count(spark, documents):
    stop = set(terms.english_stop_words())
    bags = [[w for w in r[0] if w not in stop] for r in documents.select(words()).collect()]
    cf, df = {}, {}
    for bag in bags:
        for w in bag:
            cf[w] = cf.get(w, 0) + 1
        for w in set(bag):
            df[w] = df.get(w, 0) + 1
    got = terms.term_counts(documents, words(), list(stop)).collect()
    assert {r.term: (r.cf, r.df) for r in got} == {w: (cf[w], df[w]) for w in cf}


def test_vocabulary_and_idf_equal_the_library(spark, documents):
    tokens = documents.select(
        F.filter(words(), lambda w: ~w.isin(terms.english_stop_words())).alias("w")
    )
    model = CountVectorizer(inputCol="w", outputCol="tf", vocabSize=100000, minDF=5).fit(tokens)
    weights = IDF(inputCol="tf", outputCol="x").fit(model.transform(tokens))
    library = dict(zip(model.vocabulary, weights.idf.toArray()))
    counts = terms.term_counts(documents, words(), terms.english_stop_words())
    mine = terms.with_idf(terms.vocabulary(counts, 100000), documents)
    got = {r.term: r.idf for r in mine.collect()}
    assert got.keys() == library.keys()
    assert all(math.isclose(got[t], library[t], rel_tol=1e-12) for t in got)


def test_a_tie_at_the_vocabulary_cut_is_settled_by_name(spark):
    counts = spark.createDataFrame([("b", 9, 5), ("a", 9, 5), ("c", 10, 5), ("d", 99, 4)], "term string, cf long, df long")
    assert [r.term for r in terms.vocabulary(counts, 2).collect()] == ["c", "a"]


def test_term_bayes_equals_the_library(spark, documents):
    train = documents.where(is_train("doc_id"))
    mine = TermNaiveBayes.fit(train, "lang", words(), terms.english_stop_words(), min_df=3)
    plan = ReviewPlan(
        key="doc_id", target="lang", feature_set="text", classifier="nb", min_df=3, clean=False
    )
    library = plan.fit(documents)
    vocabulary = library[0].stages[3].vocabulary
    theta = library[1].stages[0].theta.toArray()
    names = library[0].stages[0].labels
    assert names == mine.classes
    got = {(r.term, r.label): r.log_prob for r in mine.parameters().collect()}
    assert len(got) == theta.size
    for i, name in enumerate(names):
        for j, term in enumerate(vocabulary):
            assert math.isclose(got[(term, name)], theta[i][j], abs_tol=1e-9)
    scored = features.unindex_label([*names, "?"], "prediction", "guess").transform(
        artifacts.chain_models(*library).transform(documents)
    )
    expected = {r.doc_id: r.guess for r in scored.select("doc_id", "guess").collect()}
    predicted = mine.predict(documents, "doc_id", words(), ["lang"]).collect()
    assert {r.doc_id: r.prediction for r in predicted} == expected


def test_large_model_table_takes_the_salted_path(spark, documents):
    train = documents.where(is_train("doc_id"))
    model = TermNaiveBayes.fit(train, "lang", words(), min_df=3)
    small = sorted(model.predict(documents, "doc_id", words()).collect())
    model.table_bytes = 2**40
    assert sorted(model.predict(documents, "doc_id", words()).collect()) == small


def test_documents_without_known_words_get_the_prior(spark, documents):
    model = TermNaiveBayes.fit(documents, "lang", words(), min_df=3)
    empty = spark.createDataFrame([(1, ""), (2, "qqqqq zzzzz")], "doc_id long, text string")
    got = model.predict(empty, "doc_id", words()).collect()
    assert {r.doc_id: r.prediction for r in got} == {1: model.classes[0], 2: model.classes[0]}


def test_multinomial_refuses_negative_counts(documents):
    rows = documents.withColumn("n", F.lit(-1))
    with pytest.raises(ValueError):
        TermNaiveBayes.fit(rows, "lang", words(), numeric=["n"])


def test_gaussian_bayes_equals_the_library(spark, shapes):
    stages = [
        StringIndexer(inputCol="lang", outputCol="label"),
        VectorAssembler(inputCols=features.SHAPE_COLUMNS, outputCol="features"),
        NaiveBayes(modelType="gaussian"),
    ]
    library = Pipeline(stages=stages).fit(shapes)
    mine = GaussianNaiveBayes.fit(shapes, "lang", features.SHAPE_COLUMNS)
    assert mine.classes == library.stages[0].labels
    fitted = library.stages[2]
    for i in range(len(mine.classes)):
        for j in range(4):
            assert math.isclose(mine.means[i][j], fitted.theta.toArray()[i][j], rel_tol=1e-9)
            assert math.isclose(mine.variances[i][j], fitted.sigma.toArray()[i][j], rel_tol=1e-6)
    back = features.unindex_label(mine.classes, "prediction", "guess")
    expected = {r.doc_id: r.guess for r in back.transform(library.transform(shapes)).collect()}
    assert {r.doc_id: r.prediction for r in mine.predict(shapes).collect()} == expected


def test_scaled_components(shapes):
    stages = [
        features.assemble(features.SHAPE_COLUMNS),
        features.scale(std=False, mean=True),
        features.principal_components(3, "scaled"),
    ]
    model = Pipeline(stages=stages).fit(shapes)
    shares = list(model.stages[2].explainedVariance)
    assert shares == sorted(shares, reverse=True) and sum(shares) <= 1 + 1e-9
    values = vector_to_array(F.col("scaled"))
    means = model.transform(shapes).select(*(F.avg(values[i]) for i in range(4))).first()
    assert all(abs(m) < 1e-8 for m in means)


@pytest.mark.parametrize("classifier, scaling", [
    ("lr", None), ("lr", "std"), ("dt", None), ("rf", "pca"), ("gnb", "mean"), ("mlp", "std"), ("ovr", "std"),
])
def test_tabular_jobs(shapes, classifier, scaling):
    plan = TabularPlan("doc_id", features.SHAPE_COLUMNS, "lang", classifier, scaling, max_iter=5, reg=0.01)
    model = plan.fit(shapes)
    scored = plan.score(model, shapes)
    assert scored.count() == shapes.count()
    langs = {r[0] for r in shapes.select("lang").distinct().collect()}
    assert {r[0] for r in scored.select("predicted_label").distinct().collect()} <= langs
    transformed = model.transform(shapes)
    if "probability" in transformed.columns:
        sums = transformed.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x))
        assert all(math.isclose(r[0], 1.0, abs_tol=1e-6) for r in sums.collect())
    report = {(r.part, r.metric): r.value for r in plan.report(scored).collect()}
    majority = shapes.groupBy("lang").count().agg(F.max("count")).first()[0] / shapes.count()
    assert report[("train", "accuracy")] >= majority - 0.05


def test_tuning_keeps_the_best_candidate(shapes):
    plan = TabularPlan("doc_id", features.SHAPE_COLUMNS, "lang", "lr", "std", max_iter=3)
    tuned = plan.tune(shapes, [0.001, 10.0])
    assert len(tuned.avgMetrics) == 2 and tuned.avgMetrics[0] > tuned.avgMetrics[1]
    assert plan.score(tuned.bestModel, shapes).count() == shapes.count()


@pytest.mark.parametrize("how", [
    dict(classifier="lr", feature_set="full", max_iter=3),
    dict(classifier="dt", feature_set="votes", max_depth=2),
    dict(classifier="nb", feature_set="text", tokenizer="stems", idf=True, fit_on="all"),
])
def test_review_jobs(spark, documents, tmp_path, how):
    reviews = features.text_votes(documents).withColumn("stars", F.col("doc_id") % 6)
    plan = ReviewPlan(key="doc_id", min_df=2, target_range=(0, 5), votes=features.VOTE_COLUMNS, **how)
    rows = plan.prepare(reviews)
    assert rows.count() == reviews.where("stars > 0").count()
    models = plan.fit(rows)
    scored = plan.score(models, rows)
    assert scored.count() == rows.count()
    assert {r.part for r in plan.report(scored).collect()} == {"train", "test"}
    for i, model in enumerate(models):
        artifacts.save_model(model, f"{tmp_path}/{i}")
    loaded = [PipelineModel.load(f"{tmp_path}/{i}") for i in range(2)]
    assert sorted(plan.score(loaded, rows).collect()) == sorted(scored.collect())


def test_large_counts_are_trained_on_and_scored(spark):
    rows = [(i, float(i % 2 + 1), f"word{i % 2} text", 1 + i % 3, i % 4, 2) for i in range(200)]
    rows += [(1000 + i, 1.0, "word0 text", 5000, 5000, 5000) for i in range(20)]
    names = "doc_id long, stars double, text string, funny int, useful int, cool int"
    plan = ReviewPlan(key="doc_id", min_df=1, max_iter=5)
    prepared = plan.prepare(spark.createDataFrame(rows, names))
    assert prepared.count() == 220
    assert prepared.where("funny_useful_cool = 125e9").count() == 20
    scored = plan.score(plan.fit(prepared), prepared)
    assert scored.where("doc_id >= 1000 AND part = 'train'").count() > 0 and scored.count() == 220


def test_term_weights_shuffle_nothing(spark, documents, capsys):
    counts = materialize(terms.term_counts(documents, words()), "counts")
    idf = materialize(terms.with_idf(terms.vocabulary(counts, 500), documents), "idf")
    source = spark.read.parquet(f"{SF}/documents.parquet")
    weights = terms.term_weights(source, "doc_id", words(), idf)
    weights.explain()
    plan = capsys.readouterr().out
    assert "BroadcastExchange" in plan and "hashpartitioning" not in plan
    grouped = source.select("doc_id", F.explode(words()).alias("term")).groupBy("doc_id", "term").count()
    expected = grouped.join(idf.select("term"), "term").select("doc_id", "term", "count")
    assert sorted(map(tuple, weights.select("doc_id", "term", "tf").collect())) == sorted(map(tuple, expected.collect()))


def test_the_cut_of_a_vocabulary_equals_an_ordered_limit(spark):
    rows = [(f"t{i:03d}", 1 + i % 7, 1 + i % 3) for i in range(200)]
    counts = spark.createDataFrame(rows, "term string, cf long, df long")
    kept = [r for r in rows if r[2] >= 2]
    for size in (1, 20, 57, 100, 132, 133, 1000):
        expected = sorted(kept, key=lambda r: (-r[1], r[0]))[:size]
        assert sorted(map(tuple, terms.vocabulary(counts, size, 2).collect())) == sorted(expected)
    assert terms.vocabulary(counts.limit(0), 5, 2).count() == 0


def test_too_many_labels_are_refused(spark):
    df = spark.createDataFrame([(i, f"label {i}") for i in range(30)], "id int, label_text string")
    with pytest.raises(ValueError):
        features.checked_labels(df, "label_text", most=20)
    assert features.checked_labels(df, "label_text", most=30) is df


def test_stored_tokens_give_the_same_models_as_texts(spark):
    rows = [(i, "good fine great" if i % 2 else "bad poor\nawful", i % 2, 1, 2, 3) for i in range(60)]
    rows += [(100, None, 1, 1, 1, 1), (101, " ", 1, 1, 1, 1), (102, "good bad", None, 1, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, stars int, funny int, useful int, cool int")
    plan = ReviewPlan(key="doc_id", min_df=1, classifier="nb")
    stored = plan.prepare(plan.with_tokens(df))
    assert "text" not in stored.columns and stored.count() == 60
    texts = plan.prepare(df)
    from_tokens, from_texts = plan.fit(stored), plan.fit(texts)
    found = [
        sorted(map(tuple, plan.score(models, part).collect()))
        for models in (from_tokens, from_texts)
        for part in (stored, texts)
    ]
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) == 60


def test_tree_input_is_dealt_by_its_width_and_gives_the_same_tree(spark, monkeypatch):
    """Forty bytes a row for ten features; a partition holds ten rows of them, not all."""
    rows = spark.range(200).coalesce(1).select(
        (F.col("id") % 3 == 0).cast("double").alias("label"),
        array_to_vector(F.array(*(((F.col("id") * k) % 11).cast("double") for k in range(1, 11)))).alias("features"),
    )
    monkeypatch.setattr(classifiers, "_TREE_BYTES", 400)
    dealt = classifiers.dealt_for_trees(rows, 200)
    sizes = [n for n in dealt.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()]
    assert sum(sizes) == 200 and max(sizes) <= 15
    trees = [classifiers.decision_tree().fit(df).toDebugString.split("\n", 1)[1] for df in (rows, dealt)]
    assert trees[0] == trees[1]
    assert classifiers.dealt_for_trees(rows.where("label > 5"), 0).count() == 0


def test_a_review_tree_is_fitted_on_dealt_rows(spark, monkeypatch):
    seen = []
    dealt = classifiers.dealt_for_trees
    monkeypatch.setattr(classifiers, "dealt_for_trees", lambda *a: seen.append(a[1]) or dealt(*a))
    df = spark.range(60).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).alias("stars"),
        F.when(F.col("id") % 2 == 0, "good fine nice").otherwise("bad poor sad").alias("text"),
    )
    plan = ReviewPlan(key="doc_id", min_df=1, feature_set="text", classifier="dt")
    prepared = plan.prepare(df)
    scored = plan.score(plan.fit(prepared), prepared)
    assert seen == [plan.training_rows(prepared).count()] and scored.where("label <> prediction").count() == 0
