"""Queries over the given tables, and the pipeline stage by stage."""

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from scorestream.llm import private, queries, simhash, tokens
from tests.llm.test_private import brute as private_spans
from tests.llm.test_simhash import brute_components, brute_fingerprint

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "op4_vantage_neighbours"])
def test_queries_return_a_row_for_every_row(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    table = "pages" if name.startswith("op7_") else "documents"
    if not name.startswith(("op6_", "op11_", "op13_")):
        assert found.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_neighbours_equal_their_sql(spark):
    found = queries.QUERIES["op4_vantage_neighbours"](spark, SMALL)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS FROM '{SMALL}/embeddings.parquet'")
    expected = duckdb.sql(queries.ORACLES["op4_vantage_neighbours"]).fetchall()
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == sorted(expected)


def test_groups_equal_a_comparison_of_all_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    codes = [brute_fingerprint(r["text"]) for r in docs]
    groups = brute_components([r["doc_id"] for r in docs], codes)
    found = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op2_simhash"](spark, SMALL).collect()}
    for row, code, group in zip(docs, codes, groups):
        assert found[row["doc_id"]] == (row["doc_id"], f"{code:016x}", group)


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


ROWS = [
    (1, "The thing of that and the other, ing the thing", "en", "s", 46), (2, "The thing of that and the other, ing the thing", "en", "s", 46),
    (3, None, None, None, None), (4, "", "en", "s", 0), (5, "123 !!", "en", "s", 6), (6, "Mail a@b.co and the thing of that", "en", "s", 33),
    (None, "The thing of that", "en", "s", 17),
]


def documents(spark):
    return spark.createDataFrame(
        [(*r, "kept") for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long, component_id string"
    )


def test_stages_keep_the_columns_and_clean_rows(spark):
    docs = documents(spark)
    spoken = stage("language")(spark, docs, SMALL)
    assert spoken.columns == docs.columns and {r["doc_id"] for r in spoken.collect()} == {1, 2, 6, None}
    distinct = stage("near_copies")(spark, docs, SMALL)
    assert distinct.columns == docs.columns and {r["doc_id"] for r in distinct.collect()} == {1, 3, 5, 6, None}
    unleaked = stage("benchmark_leaks")(spark, docs, SMALL)
    assert unleaked.columns == docs.columns and unleaked.count() == len(ROWS)
    redacted = stage("personal_data")(spark, docs, SMALL)
    assert redacted.columns == docs.columns
    row = redacted.where("doc_id = 6").first()
    assert (row["text"], row["n_chars"]) == ("Mail [EMAIL] and the thing of that", 34)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, docs.limit(0), SMALL).count() == 0


def test_near_copies_are_linked_without_a_broadcast_of_replicas(spark, monkeypatch):
    plans = []

    def seen(links, name, run=simhash.smallest_reachable):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return run(links, name)

    monkeypatch.setattr(simhash, "smallest_reachable", seen)
    assert stage("near_copies")(spark, documents(spark), SMALL).count() == len(ROWS) - 2
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "BroadcastExchange" not in plans[0]


def test_a_leaking_document_goes(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("length(text) > 150").first()["text"]
    docs = spark.createDataFrame([(1, "So " + item + " it is.", "en", "s", 1), (2, "So it is.", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in stage("benchmark_leaks")(spark, docs, SMALL).collect()] == [2]


def test_the_run_equals_its_stages_by_brute_force(spark):
    """Exact copies and near copies one each, leaks gone, base spans redacted, ids as the library has them."""
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    groups = brute_components([r["doc_id"] for r in rows], [brute_fingerprint(r["text"]) for r in rows])
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = [r for r, g in zip(rows, groups) if r["doc_id"] == g and not any(i in r["text"] for i in items)]
    assert {r["doc_id"] for r in kept} >= set(found) and len(found) >= 0.98 * len(kept)
    ranks = {token: i for i, token in enumerate(tokens.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    same = 0
    for row in kept:
        text = private.redacted(row["text"], private_spans(row["text"]))
        if row["doc_id"] in found:
            assert found[row["doc_id"]]["round_trip"]
            same += found[row["doc_id"]]["ids"] == library.encode_ordinary(text)
    assert same >= 0.98 * len(found)


def test_a_leak_is_judged_by_its_text_whatever_its_id(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("length(text) > 150").first()["text"]
    rows = [(None, "So " + item, "en", "s", 1), (2, item, "en", "s", 1), (2, "So it is.", "en", "s", 1), (3, None, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _leak long")
    kept = stage("benchmark_leaks")(spark, docs, SMALL).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(2, "So it is."), (3, "")]
