import re
from itertools import combinations

import numpy as np

from scorestream.llm import templates

ITEM = "If John Smith has 5 apples and buys 12 apples for 30 cents then how many apples does he have when Mary takes 5 from John today"
ASKED_ANEW = "Foo bar. If Anna Jones has 7 apples and buys 40 apples for 22 dollars then how many apples does he have when Peter takes 7 from Anna today. Foo"
OTHER_SLOTS = "If Anna Jones has 7 apples and buys 40 apples for 22 dollars then how many apples does he have when Peter takes 9 from Rita today"


def leaks(spark, documents, items):
    docs = spark.createDataFrame(documents, "doc_id long, text string, item_id string, hash int")
    bench = spark.createDataFrame(items, "item_id long, text string, doc_id string, hash int")
    rows = templates.contaminated(docs, bench).collect()
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in rows}


def test_values_may_change_if_they_change_alike(spark):
    documents = [(1, ASKED_ANEW, "", 0), (2, OTHER_SLOTS, "", 0), (3, "So: " + ITEM.upper(), "", 0), (4, "x " + ITEM + " y", "", 0)]
    found = leaks(spark, documents, [(9, ITEM, "", 0)])
    assert found == {(1, 9): "reparameterised", (3, 9): "verbatim", (4, 9): "verbatim"}


def test_edge_texts_match_nothing(spark):
    documents = [(1, None, "", 0), (2, "", "", 0), (3, ITEM, "", 0), (3, ITEM, "", 0), (None, ITEM, "", 0), (5, "word " * 100_000, "", 0), (6, "1 2 3 4 5 6 7 8 9 10 11 12", "", 0)]
    items = [(1, None, "", 0), (2, "", "", 0), (3, "too short to tell", "", 0), (4, "1 2 3 4 5 6 7 8 9 10", "", 0), (7, ITEM, "", 0), (7, ITEM, "", 0), (None, ITEM, "", 0)]
    assert leaks(spark, documents, items) == {(3, 7): "verbatim"}
    assert leaks(spark, documents, items[:2]) == {}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert templates.contaminated(empty, empty.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_a_half_of_an_item_is_enough_and_a_quarter_is_not(spark):
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{'xyz'[i % 3]}" for i in range(60)]
    documents = [(1, " ".join(words[:40]), "", 0), (2, " ".join(words[:20]), "", 0), (3, " ".join(words[:28] + ["inserted"] + words[28:]), "", 0)]
    assert set(leaks(spark, documents, [(1, " ".join(words), "", 0)])) == {(1, 1), (3, 1)}


def test_every_copied_item_is_found_and_nothing_else(spark):
    folder = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, bench).collect()}
    items = {r["item_id"]: re.escape(r["text"]) for r in bench.collect()}
    copied = {
        (r["doc_id"], i) for r in docs.select("doc_id", "text").collect() for i, text in items.items() if re.search(text, r["text"])
    }
    assert copied and copied <= found
    by_id = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for doc, item in found - copied:
        words = re.findall(r"\w+", items[item].replace("\\", ""))
        assert set(w.lower() for w in words[1:-1]) <= set(re.findall(r"\w+", by_id[doc].lower()))


def test_the_filter_keeps_every_window(spark):
    codes = templates.Codes()
    text = "one two three four five six seven eight nine ten"
    out, _, slots = templates.template(text, codes)
    positions, hashes = templates.window_hashes(out, slots)
    assert list(positions) == [0, 1, 2]
    again = templates.window_hashes(out[1:9], slots[1:9])[1]
    assert again[0] == hashes[1] and len(set(hashes)) == 3


TOM = (
    "Tom has 3 red apples in a basket. Tom buys 4 more apples at the market. "
    "Tom gives 2 of them to a friend. Tom eats 5 of them at home. How many apples are left?"
)
WORKER = (
    "Sara works 5 hours a day in the town library. Sara earns 12 dollars for each hour of work. "
    "Sara spends 20 dollars on food every day. Sara saves all that is left of it. "
    "How much money does the worker save in 6 days?"
)


def test_names_that_open_sentences_may_change(spark):
    anna = TOM.replace("Tom", "Anna").replace("3", "7").replace("4", "9").replace("2 of", "8 of")
    peter = WORKER.replace("Sara", "Peter").replace("5 hours", "7 hours").replace("12", "15").replace("20", "31").replace("6 days", "9 days")
    mixed = TOM.replace("Tom has", "Anna has").replace("Tom buys", "Rita buys").replace("Tom gives", "Paul gives").replace("Tom eats", "Olga eats")
    documents = [(1, anna, "", 0), (2, "Well. " + peter, "", 0), (3, TOM, "", 0), (4, mixed, "", 0)]
    found = leaks(spark, documents, [(8, TOM, "", 0), (9, WORKER, "", 0)])
    assert found == {(1, 8): "reparameterised", (2, 9): "reparameterised", (3, 8): "verbatim"}


def test_an_opening_word_that_is_no_name_costs_its_own_windows_only(spark):
    item = "The red box holds many small things that nobody ever counts or sorts. The blue box is the one that people like to open first of all."
    other = item.replace("The red", "A red")
    lowered = "he said that " + item[0].lower() + item[1:].replace(". The", " and so the")
    found = leaks(spark, [(1, other, "", 0), (2, lowered, "", 0)], [(9, item, "", 0)])
    assert set(found) >= {(1, 9)}


def test_readings_of_a_window_are_all_choices_of_openers():
    rng = np.random.default_rng(4)
    codes = rng.integers(64, 1 << 62, 30).astype(np.uint64) & ~np.uint64(7)
    openers, slots = rng.random(30) < 0.4, rng.random(30) < 0.2
    slots &= ~openers
    seen = {(int(p), tuple(o)): int(h) for at, hs, own in templates.readings(codes, slots, openers) for p, h, o in zip(at, hs, own.tolist())}
    expected = {}
    for p in range(30 - templates.WINDOW + 1):
        here = [k for k in range(templates.WINDOW) if openers[p + k]]
        for n in range(len(here) + 1):
            for own in combinations(here, n):
                if slots[p : p + templates.WINDOW].sum() + n <= templates.WINDOW - templates.LITERALS:
                    read = codes.copy()
                    read[[p + k for k in own]] = templates.NAME_SLOT
                    expected[p, own] = int(templates.window_hashes(read[p : p + templates.WINDOW], np.zeros(templates.WINDOW, bool))[1][0])
    assert seen == expected


def test_numbers_in_words_may_change(spark):
    item = "Rita has three apples and four more in a bag. She sells them all for two dollars each to Paul. How many dollars does she have now?"
    other = item.replace("three", "five").replace("four", "nine").replace("two", "6")
    mixed = item.replace("three", "five").replace("She sells", "She sells three of")
    assert leaks(spark, [(1, other, "", 0), (2, item, "", 0)], [(9, item, "", 0)]) == {(1, 9): "reparameterised", (2, 9): "verbatim"}
    assert (2, 9) not in leaks(spark, [(2, mixed.replace("four", "five"), "", 0)], [(9, item, "", 0)])


def test_tokens_equal_their_pattern():
    text = "3.5, x_y ½² Ünï—codé ١٢ a1b2.c\x00d\x1f e f I.B.M. 1,000. Two\nthree! e\u0301 \ud800z"
    pattern = re.compile(r"[^\W\d_]+|\d[\d.,]*|[.!?\n]")
    expected = ["." if t in ".!?\n" else t for t in pattern.findall(text)]
    assert [t.decode() for t in templates.token_list(text)] == expected


def test_a_window_whose_openers_are_left_out_meets_every_reading():
    rng = np.random.default_rng(6)
    item = rng.integers(64, 1 << 62, 8).astype(np.uint64) & ~np.uint64(7)
    for openers in ([], [0], [7], [2, 5]):
        for named in combinations(openers, min(1, len(openers))):
            doc, read, marks = item.copy(), item.copy(), np.zeros(8, bool)
            marks[openers] = True
            read[list(named)] = templates.NAME_SLOT
            doc[list(named)] = np.uint64(640)
            found = templates.probes(doc, marks)[0][0]
            assert found == templates.left_out(read[None], marks, sum(1 << k for k in openers))[0]


def test_texts_cut_together_are_cut_apart():
    codes = templates.Codes()
    texts = ["Ann has 3 cats", "", "kg of two. Tom", "three", "five mm six"]
    together = templates.flat_tokens(texts, codes)
    apart = [templates.tokens_of(t, codes) for t in texts]
    for k in range(4):
        assert together[k].tolist() == [x for a in apart for x in a[k].tolist()]
    assert not templates._one_text(together[4]).any()
