import pytest
from pyspark.sql import functions as F

from scorestream.operators import clean, lookup, project, sets, split


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_blanks_nan_and_nan_text_become_null(spark):
    data = [(1, "x", 1.0), (2, "  ", 1.0), (3, "NaN", 1.0), (4, "x", float("nan")), (5, None, 1.0)]
    df = spark.createDataFrame(data, "k int, s string, v double")
    out = {r.k: (r.s, r.v) for r in clean.blanks_to_null(df).collect()}
    assert out == {1: ("x", 1.0), 2: (None, 1.0), 3: (None, 1.0), 4: ("x", None), 5: (None, 1.0)}
    assert [r.k for r in clean.clean_rows(df).collect()] == [1]
    assert [r.k for r in clean.clean_rows(df, ["s"]).orderBy("k").collect()] == [1, 4]
    profile = {r["column"]: r.n_null for r in clean.null_profile(clean.blanks_to_null(df)).collect()}
    assert profile == {"k": 0, "s": 3, "v": 1}


def test_range_filters(spark):
    df = spark.createDataFrame([(0.0, 1), (0.5, 11), (5.0, 10), (5.1, 0)], "stars double, cool int")
    assert df.where(clean.above_up_to("stars", 0, 5)).count() == 2
    assert df.where(clean.all_between(["cool"], 0, 10)).count() == 3


def test_projections(spark):
    df = spark.createDataFrame([("1", "x", 2)], "a string, b string, c int")
    assert project.rename(df, "absent", "z").columns == ["a", "b", "c"]
    with pytest.raises(ValueError):
        project.rename(df, "absent", "z", strict=True)
    assert project.columns_without(df, "b") == ["a", "c"]
    cast = project.cast_nullable(df, {"a": "int", "b": "int", "c": "string"})
    assert rows(cast) == [(1, None, "2")]
    nested = df.select(F.struct("a", "b").alias("s"), "c")
    assert project.expand_struct(nested, "s", ["c"]).columns == ["c", "a", "b"]


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(2000)
    train, test = split.hash_split(df, "id")
    again, _ = split.hash_split(df.repartition(7), "id")
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 2000
    assert 1500 < train.count() < 1700
    folds = split.fold_column(df, "id", 3).groupBy("fold").count().collect()
    assert {r.fold for r in folds} == {0, 1, 2}


def test_random_split_is_a_partition(spark):
    parts = split.random_split(spark.range(1000), seed=100)
    assert sum(p.count() for p in parts) == 1000


def test_union_keeps_duplicates_by_position(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "x")], "other int, name string")
    assert rows(sets.union_all(a, b, a)) == [(1, "x")] * 3
    assert sets.union_all(a, b).columns == ["k", "v"]


def test_top_rows(spark):
    assert [r.id for r in sets.top_rows(spark.range(50), 3, F.desc("id")).collect()] == [49, 48, 47]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_broadcast_join(spark, how):
    # One key holds more than a third of the rows.
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("term")
    )
    table = spark.createDataFrame([("hot", 1.0), ("k7", 2.0), ("k8", 3.0)], "term string, w double")
    assert lookup.measured_bytes(table) == 3 * 16 + 7
    small = lookup.lookup_join(big, table, "term", how, 100)
    salted = lookup.lookup_join(big, table, "term", how, 100, limit=10, salts=4)
    assert rows(small.select("id", "term", "w")) == rows(salted.select("id", "term", "w"))


def test_previews_show_schema_and_first_rows(spark, capsys):
    from scorestream.sources import sinks

    df = spark.createDataFrame([(i, "x" * 30) for i in range(5)], "k int, s string").orderBy("k")
    sinks.preview(df, 2, truncate=True)
    shown = capsys.readouterr().out
    assert "k: integer" in shown and "..." in shown and "only showing top 2 rows" in shown
    assert sets.first_rows(df, 3).count() == 3


def test_random_parts_are_disjoint_and_add_up(spark):
    df = spark.range(1000)
    left, right = split.random_split(df, (0.7, 0.3), seed=5)
    assert left.count() + right.count() == 1000 and left.intersect(right).count() == 0
    again, _ = split.random_split(df, (0.7, 0.3), seed=5)
    assert rows(again) == rows(left)
