import zlib

import numpy as np
import pytest

from scorestream.llm import hilbert


@pytest.mark.parametrize("dimensions, bits", [(2, 5), (3, 4), (3, 5), (4, 3), (1, 4), (2, 1)])
def test_neighbours_on_the_curve_differ_by_one_step(dimensions, bits):
    places = hilbert.curve_places(dimensions, bits)
    cells = np.argsort(places)
    assert (np.sort(places) == np.arange(len(places))).all()
    axes = np.array([cells >> (bits * d) & ((1 << bits) - 1) for d in range(dimensions)])
    assert (np.abs(np.diff(axes, axis=1)).sum(axis=0) == 1).all()


def lawful(found, shards):
    counts = {}
    for row in found:
        counts.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in counts.values())
    sizes = [len(counts.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(shards))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_shards_of_the_documents(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    found = hilbert.curve_shards(docs).collect()
    texts = {r["doc_id"]: r["text"].encode() for r in docs.select("doc_id", "text").collect()}
    assert len(found) == len(texts)
    lawful(found, 40)
    for row in found:
        text = texts[row["doc_id"]]
        assert (row["size"], row["text_crc32"], row["law"]) == (len(text) + 16, zlib.crc32(text), "rows")
        assert row["grown_shard"] is None
    by_place = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [r["place"] for r in by_place] == sorted(r["place"] for r in found)


def test_hot_cells_nulls_and_repeated_rows(spark):
    rows = [(i, "t", "en", "a", 5, 1, 2) for i in range(3000)] + [(7, "t", "en", "a", 5, 1, 2)] * 5
    rows += [(None, None, None, None, None, None, None), (-1, "", "de", "b", 1 << 40, 0, 0), (-2, "é" * 100_000, None, "", 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int, place int")
    found = hilbert.curve_shards(docs, shards=7).collect()
    assert len(found) == len(rows)
    lawful(found, 7)
    assert {r["size"] for r in found} == {17, 16, 200_016}


def test_fewer_rows_than_shards_and_none(spark):
    docs = spark.createDataFrame([(i, "x", "a", "b", i) for i in range(3)], "doc_id long, text string, lang string, source string, n_chars long")
    lawful(hilbert.curve_shards(docs).collect(), 40)
    assert hilbert.curve_shards(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        hilbert.curve_shards(docs, bits=9)


def test_places_equal_cells_by_brute_force(spark):
    """Classes from sorted lists, spread over the axis; the cell's place from the table of the curve."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "lang", "source", "n_chars").collect()
    cuts = hilbert.quantile_cuts(docs, ["lang", "source", "n_chars"], 5)
    for at, name in enumerate(["lang", "source"]):
        values = sorted(r[name] for r in rows)
        steps = [31 * k / len(values) // 1 for k in range(len(values) + 1)]
        ends = {v for v in set(values) if steps[values.index(v) + values.count(v)] > steps[values.index(v)]}
        assert cuts[at] == sorted(ends - {values[-1]})
    places = hilbert.curve_places(3, 5)
    found = {r["doc_id"]: r["place"] for r in hilbert.curve_shards(docs).collect()}
    for row in rows:
        cell = 0
        for name, own in zip(["lang", "source", "n_chars"], cuts):
            cell = cell * 32 + (1 + sum(row[name] > c for c in own)) * 31 // (len(own) + 1)
        assert found[row["doc_id"]] == places[cell]


def test_shards_are_narrow_in_every_dimension(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = hilbert.curve_shards(docs).select("doc_id", "shard").join(docs, "doc_id")
    narrow = found.groupBy("shard").agg(hilbert.F.count_distinct("lang").alias("l"), hilbert.F.count_distinct("source").alias("s"), (hilbert.F.percentile("n_chars", 0.9) - hilbert.F.percentile("n_chars", 0.1)).alias("r"))
    l, s, r = narrow.agg({"l": "avg", "s": "avg", "r": "avg"}).select("avg(l)", "avg(s)", "avg(r)").first()
    mixed = docs.withColumn("shard", hilbert.F.pmod(hilbert.F.xxhash64("doc_id"), hilbert.F.lit(40)))
    mixed = mixed.groupBy("shard").agg(hilbert.F.count_distinct("lang").alias("l"), hilbert.F.count_distinct("source").alias("s"), (hilbert.F.percentile("n_chars", 0.9) - hilbert.F.percentile("n_chars", 0.1)).alias("r"))
    ml, ms, mr = mixed.agg({"l": "avg", "s": "avg", "r": "avg"}).select("avg(l)", "avg(s)", "avg(r)").first()
    assert l < 2.2 and l < 0.7 * ml and s < 0.7 * ms and r < 0.8 * mr


def test_sources_with_a_long_common_beginning_are_told_apart(spark):
    rows = [(i, "t", "en", f"https://example.org/{'abcd'[i % 4]}", 5.0) for i in range(400)]
    rows += [(400, "t", "en", "https://example.org/a", float("nan")), (401, "t", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars double")
    assert len(hilbert.quantile_cuts(docs, ["source"], 5)[0]) == 3
    found = hilbert.curve_shards(docs, shards=4).join(docs.select("doc_id", "source"), "doc_id").collect()
    lawful(found, 4)
    per_shard = [{r["source"] for r in found if r["shard"] == k and r["source"]} for k in range(4)]
    assert sum(map(len, per_shard)) <= 7
