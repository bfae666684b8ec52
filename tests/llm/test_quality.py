"""The leader against a plain dictionary form of its updates; held-out accuracy; edge rows."""

import math
import zlib

import numpy as np

from scorestream.llm import quality, queries

SMALL = "/root/testdata/sf0.01"


def plain_leader(rows, buckets, alpha=2.0, beta=1.0, l1=0.02, l2=0.1):
    z, n = {}, {}

    def weight(i):
        if i not in z:
            return 0.0
        small = l1 if i != buckets else 0.0
        if abs(z[i]) <= small:
            return 0.0
        return -(z[i] - math.copysign(small, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for places, values, label in rows:
        row = [*zip(places, values), (buckets, 1.0)]
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in row)))
        now = {i: weight(i) for i, _ in row}
        for i, v in row:
            g = (p - label) * v
            s = (math.sqrt(n.get(i, 0) + g * g) - math.sqrt(n.get(i, 0))) / alpha
            z[i] = z.get(i, 0) + g - s * now[i]
            n[i] = n.get(i, 0) + g * g
    return [weight(i) for i in range(buckets + 1)]


def test_updates_equal_their_plain_form():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(300):
        places = np.sort(rng.choice(40, rng.integers(0, 8), replace=False))
        rows.append((places, rng.random(len(places)), int(rng.random() < 0.4)))
    leader = quality.Leader(40, l1=1.0)
    for places, values, label in rows:
        leader.update(places, values, label)
    expected = plain_leader([(p.tolist(), v.tolist(), y) for p, v, y in rows], 40, l1=1.0)
    assert np.allclose(leader.weights(), expected, atol=1e-12) and 0.0 in leader.weights()


def test_the_rows_of_a_long_text_do_not_depend_on_the_cut(monkeypatch):
    text = "One two, two three!!! ONE $$$ two " * 50 + "end"
    whole = quality.sparse(text, 1 << 12, quality._Codes())
    monkeypatch.setattr(quality, "BLOCK_CHARS", 40)
    cut = quality.sparse(text, 1 << 12, quality._Codes())
    assert (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])
    assert math.isclose((whole[1] ** 2).sum(), 1)
    assert quality.sparse(None, 8, {})[0].size == quality.sparse(" \n", 8, {})[0].size == 0


def test_scores_are_sparse_dot_products(spark):
    model = quality.QualityModel(np.random.default_rng(2).normal(size=(1 << 10) + 1))
    texts = ["The cat sat.", "", None, "a " * 30_000, "The cat sat."]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)] + [(None, "b", 7, "x")], "doc_id long, text string, score int, predicted string")
    rows = {r["doc_id"]: r for r in quality.score_quality(docs, model).collect()}
    assert len(rows) == 6 and rows[0]["score"] == rows[4]["score"] and rows[1]["score"] == rows[2]["score"]
    for i, text in enumerate(texts):
        places, values = quality.sparse(text, 1 << 10, quality._Codes())
        dot = sum(model.weights[p] * v for p, v in zip(places, values)) + model.weights[-1]
        assert math.isclose(rows[i]["score"], 1 / (1 + math.exp(-dot)), rel_tol=1e-9)
        assert rows[i]["predicted"] == (rows[i]["score"] >= 0.5)


def test_labels_missing_of_one_kind_or_empty(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    assert quality.fit_quality(docs, labels) == 1.0
    assert quality.fit_quality(docs, labels.limit(0)) == 0.5
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 5)], "doc_id long, quality int")
    assert quality.fit_quality(docs, odd) == 0.5
    assert {r["predicted"] for r in quality.score_quality(docs, 0.25).collect()} == {0}
    assert quality.score_quality(docs.limit(0), 0.25).count() == 0


def test_labels_of_the_held_out_third_are_never_read(spark):
    """Labels of that third turned over give the same weights; a second fit gives them again."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("quality", quality.F.when(quality.in_held_out_third(quality.F.col("doc_id")), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    first, second = quality.fit_quality(docs, labels), quality.fit_quality(docs, turned)
    assert np.allclose(first.weights, second.weights)


def test_held_out_quality(spark):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_leader_quality"](spark, SMALL).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    held = [(labels[i], r["predicted"]) for i, r in rows.items() if r["held_out"] and i in labels]
    for label in (0, 1):
        assert np.mean([p == y for y, p in held if y == label]) > 0.9
