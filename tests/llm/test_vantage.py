import numpy as np
import pytest
from pyspark.sql import functions as F

from scorestream.llm import vantage

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(rows, k, asks):
    usable = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    queries = {}
    for i, v in usable:
        if asks(i):
            key = (i, len(v))
            queries[key] = min(queries.get(key, v), v, key=list)
    out = []
    for i, n in sorted(queries):
        q = queries[i, n]
        scored = [
            (-float(vantage.exact_cosine(q[None], v[None])[0]), j) for j, v in usable if j != i and len(v) == n
        ]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return out


def frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], "x", 1) for i, v in rows]
    return spark.createDataFrame(rows, SCHEMA), [(r[0], r[1]) for r in rows]


def found(df, k=5, **how):
    rows = vantage.nearest(df, F.col("vec_id") % 10 == 0, k, **how).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


@pytest.mark.parametrize("shard_rows", [50, 4096])
def test_factor_one_is_exact_search(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(vantage, "LEAF", 8)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8)) for i in range(400)]
    rows += [(i, rows[10][1]) for i in range(400, 520)] + [(i, 3 * rows[20][1]) for i in range(520, 540)]
    df, rows = frame(spark, rows)
    assert found(df, shard_rows=shard_rows) == brute(rows, 5, lambda i: i % 10 == 0)


def test_clusters_are_pruned_without_loss():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 5
    vectors = np.concatenate([c + 0.05 * rng.normal(size=(100, 16)) for c in centres])
    ids = np.arange(len(vectors))
    looked = []

    class Watched(vantage.Best):
        def offer(self, who, tree, rows, unit):
            looked.append(len(who) * (rows.stop - rows.start))
            super().offer(who, tree, rows, unit)

    tree = vantage.VantageTree(ids, vectors, leaf=25)
    queries = vectors[::50]
    plain, vantage.Best = vantage.Best, Watched
    try:
        at, near, score = tree.search(ids[::50], queries, 5)
    finally:
        vantage.Best = plain
    assert sum(looked) < 0.3 * len(queries) * len(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in range(len(queries)):
        order = [j for j in np.argsort(-(unit @ unit[50 * q]), kind="stable") if j != 50 * q][:5]
        assert set(near[at == q]) == set(order)


def test_a_larger_factor_looks_at_less_and_keeps_most():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(2000, 6))
    tree = vantage.VantageTree(np.arange(2000), vectors, leaf=20)
    _, exact, _ = tree.search(np.arange(100), vectors[:100], 5)
    at, loose, _ = tree.search(np.arange(100), vectors[:100], 5, relax=1.5)
    assert len(set(zip(at, loose)) & set(zip(np.repeat(np.arange(100), 5), exact))) >= 450


def test_unusable_few_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (10, None), (20, [0.0, 0.0]), (30, [nan, 1.0]), (40, [inf, 1.0]), (50, [None, 1.0]), (60, [])]
    rows += [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (None, [1.0, 0.5]), (70, [1.0, 2.0, 3.0]), (3, [3.0, 2.0, 1.0]), (4, [-1.0, 0.0])]
    df, rows = frame(spark, rows)
    result = found(df)
    assert result == brute(rows, 5, lambda i: i % 10 == 0)
    assert [r[:3] for r in result if r[0] == 70] == [(70, 1, 3)]
    assert found(df.limit(0)) == []


def clustered(spark, clusters=40, rows=50):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(clusters, 16))
    rows = [(i, centres[i % clusters] + 0.02 * rng.normal(size=16)) for i in range(clusters * rows)]
    return frame(spark, rows)


def test_clustered_queries_go_to_few_shards(spark):
    df, rows = clustered(spark)
    asks = F.col("vec_id") % 10 == 0
    layout = vantage.lay_out(df, asks, shard_rows=50)
    assert layout.shards >= 30 and layout.placed.count() == len(rows)
    assert layout.placed.groupBy("shard").count().agg(F.max("count")).first()[0] <= 75
    home = vantage._searched(layout, layout.queries.withColumn("floor", F.lit(float("-inf"))), 5, 1.0)
    sent = vantage.sent_on(layout, vantage.with_floor(layout.queries, home, 5))
    assert sent.count() < 0.2 * layout.shards * layout.queries.count()
    assert found(df, shard_rows=50) == brute(rows, 5, lambda i: i % 10 == 0)


def test_a_vector_with_a_third_of_all_rows_is_shared_out(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6)) for i in range(200)] + [(7, [1.0] * 6)] * 100
    df, rows = frame(spark, rows)
    layout = vantage.lay_out(df, F.col("vec_id") % 10 == 0, shard_rows=20)
    sizes = [r["count"] for r in layout.placed.groupBy("shard").count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == 300
    assert found(df, shard_rows=20) == brute(rows, 5, lambda i: i % 10 == 0)


def test_a_factor_above_one_sends_fewer_queries_on(spark):
    rng = np.random.default_rng(9)
    df, _ = frame(spark, [(i, rng.normal(size=5)) for i in range(1000)])
    layout = vantage.lay_out(df, F.col("vec_id") % 10 == 0, shard_rows=40)
    home = vantage._searched(layout, layout.queries.withColumn("floor", F.lit(float("-inf"))), 5, 1.0)
    bounded = vantage.with_floor(layout.queries, home, 5)
    counts = [vantage.sent_on(layout, bounded, relax).count() for relax in (1.0, 2.0, 1e9)]
    assert counts[0] > counts[1] >= counts[2]
    assert layout.queries.count() * layout.shards > counts[0]
    exact = {r[:3] for r in found(df, shard_rows=40)}
    assert len({r[:3] for r in found(df, shard_rows=40, relax=1.3)} & exact) >= 0.9 * len(exact)


def test_widths_the_sample_has_not_met_are_searched(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=3 if i % 100 else 4)) for i in range(600)]
    df, rows = frame(spark, rows)
    monkeypatch.setattr(vantage, "LEAF_SAMPLE", 1)
    assert found(df, shard_rows=100) == brute(rows, 5, lambda i: i % 10 == 0)
