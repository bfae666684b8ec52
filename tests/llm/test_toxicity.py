import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorestream.llm import toxicity
from scorestream.llm.frames import in_held_out_fold

SF = "/root/testdata/sf0.01"


def brute_kernel(a, b):
    def weights(word):
        out = {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                key = word[i] + word[j] + word[k]
                out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    dot = sum(v * y.get(key, 0) for key, v in x.items())
    return dot / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_features_give_the_kernel():
    words = ["idiot", "idxiot", "banana", "idiotidiotidiot", "abc", "xy", ""]
    row, triple, value = toxicity.features(words)
    dense = np.zeros((len(words), toxicity.TRIPLES))
    dense[row, triple] = value
    for (i, a), (j, b) in itertools.combinations(enumerate(words[:5]), 2):
        assert dense[i] @ dense[j] == pytest.approx(brute_kernel(a, b), abs=1e-12)
    assert not dense[5:].any()


def test_folding_undoes_inserted_signs():
    assert {toxicity.fold(w) for w in ("id-iot", "i.d.i.o.t!!", "1d10t", "idiot", "(idiot)")} == {"idiot"}
    assert "idiot" in toxicity.words_of("you I D I O T there")
    assert toxicity.fold("123") == toxicity.fold("...") == ""


def test_every_part_of_a_long_word_is_read():
    word = "x" * 50 + "idiot" + "x" * 50
    assert any("idiot" in piece for piece in toxicity.chunks(word))
    assert "".join(toxicity.chunks("abc")) == "abc"


@pytest.fixture(scope="module")
def machine(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.fit_toxicity(docs, labels)


def test_labels_of_the_held_out_fold_are_told(spark, machine):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score_toxicity(docs, machine).join(labels.select("doc_id", "toxic"), "doc_id")
    held = found.where(in_held_out_fold(F.col("doc_id"))).collect()
    right = sum(r["toxic"] == r["predicted"] for r in held)
    assert right / len(held) >= 0.9
    assert sum(r["predicted"] for r in held if r["toxic"] == 0) <= 0.03 * len(held)


@pytest.mark.parametrize("word", ["trash", "tr-ash", "t.r.a.s.h", "t r a s h", "traash", "tr4sh"])
def test_disguised_insults_score_high(machine, word):
    assert machine.probability(machine.signs([word]))[0] > 0.5


def test_edge_texts_have_a_score(spark, machine):
    rows = [(1, None, 1), (2, "", 1), (3, "the thing of that", 1), (4, "a" * 300_000, 1), (4, "the trash", 1), (None, "12 !?", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = [tuple(r) for r in toxicity.score_toxicity(docs, machine).collect()]
    assert len(found) == 6 and all(0 <= r[1] <= 1 and r[2] == (r[1] >= 0.5) for r in found)
    assert {r[1] for r in found if r[0] in (1, 2)} == {machine.probability(machine.signs([""]))[0]}
    assert toxicity.score_toxicity(docs.limit(0), machine).count() == 0


def test_one_label_only_gives_its_share(spark):
    docs = spark.createDataFrame([(i, "word") for i in range(20)], "doc_id long, text string")
    for label in (0, 1):
        labels = spark.createDataFrame([(i, label) for i in range(20)], "doc_id long, toxic int")
        share = toxicity.fit_toxicity(docs, labels)
        assert share == float(label)
        assert {r["score"] for r in toxicity.score_toxicity(docs, share).collect()} == {float(label)}
    assert toxicity.fit_toxicity(docs, labels.limit(0)) == 0.0


def test_mistaken_words_are_found_in_all_negative_ones(spark, machine):
    words = ["trash", "the", "tr", "", "grash"]
    found = toxicity._word_margins(spark.createDataFrame([(w,) for w in words], "word string"), machine).collect()
    expected = dict(zip(words, machine.word_margins(words)))
    assert {r["word"]: r["margin"] for r in found} == pytest.approx(expected)
    assert expected["trash"] > 0.5 > expected["the"]
