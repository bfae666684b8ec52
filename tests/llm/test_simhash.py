import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scorestream.llm import components, simhash


def brute_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, codes):
    parent = {i: i for i in range(len(ids))}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    lowest = {}
    for i, own in enumerate(ids):
        if own is not None:
            lowest[root(i)] = min(own, lowest.get(root(i), own))
    return [lowest.get(root(i)) for i in range(len(ids))]


@pytest.mark.parametrize(
    "text", ["", " \t\n", "One", "a B", "A b c", "a b c d\x0be f", "É ÀÉ x y z", "a b c d", "x " * 700 + "y z"]
)
def test_fingerprints_equal_their_definition(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_votes_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(random.Random(5).choice("abcdefgh") for _ in range(500))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "COUNTED_AT_ONCE", 7)
    assert simhash.fingerprint(text.encode()) == whole == brute_fingerprint(text)


def test_every_value_meets_all_within_one_bit_at_its_own_anchor(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(40)]
    near = [v ^ 1 << rng.randrange(64) for v in values]
    rows = [(i, int(np.array(c, np.uint64).view(np.int64))) for i, c in enumerate(values + near)]
    spread = simhash.replicas(spark.createDataFrame(rows, "node long, code long")).collect()
    assert max(sum(r["node"] == n and r["half"] == 0 for r in spread) for n in range(80)) <= 16
    home = {(r["node"], r["half"]): r["anchor"] for r in spread if r["home"]}
    seen = {(r["node"], r["half"], r["anchor"]) for r in spread}
    for i in range(40):
        for half in (0, 1):
            assert (i + 40, half, home[i, half]) in seen


def test_links_equal_a_comparison_of_all_pairs(spark):
    rng = random.Random(2)
    codes = {0, 1, 7, 15, (1 << 64) - 1, 1 << 63, 1 << 31, 3 << 31}
    for _ in range(25):
        base = rng.getrandbits(64)
        codes |= {base} | {base ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 3, 3, 4, 5)}
    codes = sorted(codes)
    rows = [(i, int(np.array(c, np.uint64).view(np.int64))) for i, c in enumerate(codes)]
    found = simhash.links(spark.createDataFrame(rows, "node long, code long")).collect()
    found = {tuple(sorted((r["a"], r["b"]))) for r in found}
    assert found == {
        (i, j) for j in range(len(codes)) for i in range(j) if (codes[i] ^ codes[j]).bit_count() <= 3
    }


def test_replicas_of_few_nodes_are_shuffled_and_not_broadcast(spark):
    codes = spark.range(3000).select(F.col("id").alias("node"), F.xxhash64("id").alias("code"))
    plan = simhash.links(codes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_more_bits_than_the_anchors_guarantee_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "node long, code long"), 4)


def test_components_of_documents_with_edge_cases(spark):
    rng = random.Random(3)
    base = [rng.choice(["ab", "cd", "ef", "gh", "ij", "kl"]) for _ in range(200)]
    texts = [None, "", "  ", "Word", "word", " ".join(base), " ".join(base + ["zz"]), " ".join(["yy"] + base), "other words here now"]
    rows = [(10 * i + 5, t, "x", 1) for i, t in enumerate(texts)] + [(5, None, "x", 1), (None, "Word", "x", 1), (None, "alone", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, code int")
    found = simhash.near_copies(docs).collect()
    codes = [brute_fingerprint(r[1]) for r in rows]
    expected = sorted(
        (str(r[0]), f"{c:016x}", str(k)) for r, c, k in zip(rows, codes, brute_components([r[0] for r in rows], codes))
    )
    assert sorted((str(r[0]), r[1], str(r[2])) for r in found) == expected
    assert simhash.near_copies(docs.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "same text of all", "a"), (1, "same text of all", "b"), (1, "same text of all", "b"), (2, "quite another one", "c"), (None, "same text of all", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id string")
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r[0]), r[2]) for r in kept.collect()) == [("1", "b"), ("2", "c"), ("None", "d")]


def test_chains_and_stars_are_single_components(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, i) for i in range(1001, 1200)]
    rows = chain + star + [(7, 7), (None, 3), (61, 60), (61, 60)]
    links = spark.createDataFrame(rows, "a long, b long")
    found = {r["node"]: r["component"] for r in components.smallest_reachable(links).collect()}
    assert found == {**{i: 0 for i in range(62)}, **{i: 1000 for i in range(1000, 1200)}}
    assert components.smallest_reachable(links.limit(0)).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven eight"
    rows = [(1, a, 0), (5, a, 1), (5, b, 2)]
    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0], [2, 0, 1]):
        docs = spark.createDataFrame([rows[i] for i in order], "doc_id long, text string, row int").repartition(3)
        assert sorted(tuple(r) for r in simhash.without_near_copies(docs).collect()) == [(1, a, 0), (5, b, 2)]


def test_of_equal_ids_in_one_group_the_same_row_stays_each_time(spark):
    a = "alpha beta gamma delta epsilon zeta"
    rows = [(1, a, i % 3) for i in range(9)] + [(None, a, 7), (2, None, 1), (3, "", 1)]
    kept = set()
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, row int")
        kept.add(tuple(sorted((tuple(r) for r in simhash.without_near_copies(docs).collect()), key=repr)))
    assert len(kept) == 1 and sorted(r[0] or 0 for r in kept.pop()) == [0, 1, 2]
