import numpy as np
import pytest
from pyspark.sql import functions as F

from scorestream.llm import language
from scorestream.llm.frames import in_held_out_fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trees(spark):
    return language.fit_trees(spark.read.parquet(f"{SF}/documents.parquet"))


def brute_bits(counts, text):
    """Code length of one text, byte by byte, from counts of a byte and the four before it."""
    seen = {}
    for code, times in zip(*counts):
        *before, own = int(code).to_bytes(5, "big")
        for k in range(5):
            table = seen.setdefault(tuple(before[4 - k :]), {})
            table[own] = table.get(own, 0) + times
    stream = [*b"    ", *text]
    bits = 0.0
    for at in range(4, len(stream)):
        coded = set()
        for k in (4, 3, 2, 1, 0):
            table = seen.get(tuple(stream[at - k : at]), {})
            table = {s: c for s, c in table.items() if s not in coded}
            if not table:
                continue
            mass = sum(table.values()) + len(table)
            if stream[at] in table:
                bits -= np.log2(table[stream[at]] / mass)
                break
            bits -= np.log2(len(table) / mass)
            coded |= set(table)
        else:
            bits += np.log2(256 - len(coded))
    return bits


def test_code_lengths_equal_a_walk_through_the_trees(trees):
    for text in (b"the thing", "Über straße 12!".encode(), b"", b"zq\x00\xffxq", b"a", "ТОЖ 漢字 Ünd THE the".encode()):
        raw, bounds = np.frombuffer(b"abc" + text, np.uint8), np.array([0, 3, 3 + len(text)])
        found = trees.bits(raw, bounds)[1]
        expected = [brute_bits(c, text) for c in trees.counts]
        assert np.allclose(found, expected, atol=1e-3)


def test_windows_do_not_change_code_lengths(trees, monkeypatch):
    raw = np.frombuffer(("Der Mann und the thing " * 40).encode(), np.uint8)
    bounds = np.array([0, 0, 1, 2, 5, 400, 400, len(raw)])
    whole = trees.bits(raw, bounds)
    monkeypatch.setattr(language, "WINDOW", 7)
    assert np.allclose(trees.bits(raw, bounds), whole, atol=1e-2)


def test_held_out_languages_are_found(spark, trees):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(docs.select("doc_id", "text"), trees).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(in_held_out_fold(F.col("doc_id")))
    right, total = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / total > 0.97


def test_edge_texts_have_a_defined_language(spark, trees):
    rows = [(1, None, 9), (2, "", 9), (3, "12 34 !?", 9), (4, "the thing " * 50_000, 9), (4, "the thing", 9), (None, "der die", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    found = language.identify(docs, trees).collect()
    assert len(found) == 6
    for row in found:
        if row["doc_id"] in (1, 2, 3):
            assert (row["lang_pred"], row["score"], row["bits_per_byte"]) == ("und", 0.0, None)
        else:
            assert row["lang_pred"] in trees.languages and 0 <= row["score"] <= 1


def test_without_labelled_documents_all_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    none = language.fit_trees(docs)
    assert none.languages == []
    assert language.identify(docs, none).first()["lang_pred"] == "und"
    assert language.identify(docs.limit(0), none).count() == 0


def test_noise_goes_and_prose_stays(spark, trees):
    noise = "".join(chr(0x4E00 + 97 * i % 20000) + "qX#"[i % 3] for i in range(400))
    rows = [(1, "The thing of that", "xx", 5), (2, noise, "en", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    kept = language.with_language(docs, trees).collect()
    assert [(r["doc_id"], r["lang"], r["score"]) for r in kept] == [(1, "en", 5)]


def test_without_languages_every_row_stays(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, None)], "doc_id long, text string, lang string")
    trees = language.fit_trees(docs)
    assert not trees.languages and sorted(r["doc_id"] for r in language.with_language(docs, trees).collect()) == [1, 2]


def test_every_byte_value_is_a_symbol_of_its_own(spark):
    docs = [(i, text, lang) for i in range(40) for text, lang in (("да нет", "ru"), ("ÐАзÑб", "xx"))]
    trees = language.fit_trees(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    column = trees.alphabet()
    assert column[0xD0] and column[0xD1] and column[0xD0] != column[0xD1]
    assert column[0x00] == column[0xFF] == 0
    longest = max(len(t.longer) for t in trees.tables())
    assert longest == 4 and all(t.lengths.min() > 0 for t in trees.tables())


def test_blocks_of_contexts_do_not_change_code_lengths(trees, monkeypatch):
    columns = trees.alphabet()
    whole = language.unfolded(*trees.counts[0], columns).lengths
    monkeypatch.setattr(language, "CONTEXTS_AT_ONCE", 100)
    assert np.array_equal(language.unfolded(*trees.counts[0], columns).lengths, whole)
