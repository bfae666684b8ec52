"""As-of joins, regression, cubes and sketches against plain Python."""

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorestream.operators import classifiers, optimality
from scorestream.operators.asof import asof_join
from scorestream.operators.features import assemble
from scorestream.operators.regression import fit_linear
from scorestream.operators.summaries import SKETCH_ERROR, accuracy_cube, distinct_sketches, frequent_items, merged_distinct


def brute_asof(left, right):
    out = []
    for key, time, name in left:
        fits = [(t, v) for k, t, v in right if k is not None and k == key and t is not None and time is not None and t <= time]
        out.append((key, time, name, max(fits, key=lambda r: (r[0], r[1]))[1] if fits else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slices", [1, 4, 50])
def test_asof_equals_a_search_per_row(spark, slices):
    """Key 0 has most rows of both sides; times tie; keys and times may be null."""
    rng = random.Random(slices)
    key = lambda: rng.choice([0] * 20 + [1, 2, 3, None])
    time = lambda: rng.choice([rng.randrange(120)] * 15 + [None])
    left = [(key(), time(), f"l{i}") for i in range(300)] + [(0, 5, "same"), (0, 5, "same"), (7, 5, "alone")]
    right = [(key(), time(), i % 40) for i in range(200)] + [(8, 1, 1)]
    found = asof_join(
        spark.createDataFrame(left, "k long, t long, name string"), spark.createDataFrame(right, "key long, at long, v long").withColumnRenamed("key", "k"),
        "k", "t", "at", ["v"], slices,
    )
    assert found.columns == ["k", "t", "name", "v"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_asof(left, right)


def test_asof_of_empty_tables_and_clashing_names(spark):
    left = spark.createDataFrame([(1, 2)], "k long, t long")
    empty = spark.createDataFrame([], "k long, at long, v string")
    assert [tuple(r) for r in asof_join(left, empty, "k", "t", "at", ["v"]).collect()] == [(1, 2, None)]
    assert asof_join(left.limit(0), empty, "k", "t", "at", ["v"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(left, empty.withColumnRenamed("v", "t"), "k", "t", "at", ["t"])


def test_asof_makes_no_pairs(spark):
    left = spark.range(1000).selectExpr("id % 3 as k", "id as t")
    plan = asof_join(left, left.toDF("k", "at").withColumn("v", F.col("at")), "k", "t", "at", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_regression_equals_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 3, (400, 3))
    y = x @ [2.0, -1.0, 0.5] + 7 + rng.normal(size=400)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(5)
    model = fit_linear(df, ["a", "b", "c"], "y")
    centred = x - x.mean(axis=0)
    slopes = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    assert np.allclose(model.slopes, slopes, rtol=1e-6)
    got = [r["prediction"] for r in model.predict(df.dropna()).where("not isnan(b)").orderBy("a").collect()]
    expected = y.mean() + centred[np.argsort(x[:, 0])] @ slopes
    assert np.allclose(got, expected, atol=1e-3)


def test_regression_on_columns_that_follow_from_others(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 5.0, 3.0 * i + 1) for i in range(20)], "a double, b double, c double, y double")
    model = fit_linear(df, ["a", "b", "c"], "y")
    assert np.allclose([r["prediction"] - r["y"] for r in model.predict(df).collect()], 0, atol=1e-8) and model.slopes[2] == 0
    with pytest.raises(ValueError):
        fit_linear(df.limit(0), ["a"], "y")


def test_cube_keeps_null_values_apart_from_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0, 1]), rng.choice(["x", None]), rng.choice(["x", "y", None])) for _ in range(200)]
    df = spark.createDataFrame(rows, "s string, f long, label string, pred string")
    expected = Counter()
    hits = Counter()
    for s, f, label, pred in rows:
        for drop_s, drop_f in product((0, 1), (0, 1)):
            at = (None if drop_s else s, None if drop_f else f, 2 * drop_s + drop_f)
            expected[at] += 1
            hits[at] += label == pred
    cube = accuracy_cube(df, "label", "pred", ["s", "f"])
    got = {(r["s"], r["f"], r["level"]): (r["n_rows"], r["n_correct"]) for r in cube.collect()}
    assert got == {k: (n, hits[k]) for k, n in expected.items()}
    assert accuracy_cube(df.limit(0), "label", "pred", ["s", "f"]).count() == 0
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.rindex("HashAggregate")


def test_sketches_of_parts_merge_to_the_whole(spark):
    df = spark.range(60_000).selectExpr("id % 7 as part", "(id * 7919) % 20000 as value")
    parts = distinct_sketches(df, ["part"], "value")
    merged = merged_distinct(parts.withColumn("all", F.lit(1)), ["all"]).first()["n_distinct"]
    assert abs(merged - 20_000) <= 4 * SKETCH_ERROR * 20_000
    for row in merged_distinct(parts, ["part"]).collect():
        exact = df.where(F.col("part") == row["part"]).select("value").distinct().count()
        assert abs(row["n_distinct"] - exact) <= 4 * SKETCH_ERROR * exact


def test_frequent_items_are_found_among_many_rare_ones(spark):
    df = spark.range(40_000).selectExpr("case when id % 4 = 0 then 'hot' when id % 10 = 1 then 'warm' else concat('r', id) end as item")
    top = {r["item"]: r["count"] for r in frequent_items(df, "item", 2, tracked=2000).collect()}
    assert set(top) == {"hot", "warm"} and abs(top["hot"] - 10_000) <= 60


def test_a_slope_that_does_not_vanish_is_seen(spark):
    rng = np.random.default_rng(3)
    rows = [(float(k), *map(float, rng.normal(k, 1.5, 2))) for k in rng.integers(0, 3, 300)]
    df = assemble(["a", "b"]).transform(spark.createDataFrame(rows, "label double, a double, b double"))
    fit = lambda n: classifiers.logistic(maxIter=n, tol=1e-12, regParam=0.05, standardization=False, family="multinomial").fit(df)
    assert abs(optimality.logistic_slope(fit(300), df, "features", "label")).max() < 1e-6
    assert abs(optimality.logistic_slope(fit(1), df, "features", "label")).max() > 1e-3


def test_a_support_vector_machine_separates_what_can_be_separated(spark):
    rows = [(float(k), float(x), float(k * 4 + y)) for k in (0, 1) for x in range(5) for y in (0, 1)]
    df = assemble(["a", "b"]).transform(spark.createDataFrame(rows, "label double, a double, b double"))
    model = classifiers.linear_svc(regParam=0.001, maxIter=50).fit(df)
    assert model.transform(df).where("label <> prediction").count() == 0
