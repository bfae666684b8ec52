"""Phrases against counting every window in Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from scorestream.llm import collocation

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, best=2000, cover=80, scale=2_000_000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, longer in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * longer >= cover * candidates[p[i : i + size]]:
                        dropped.add(p[i : i + size])
        rows = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(rows[:best], 1)]
    return sorted(out)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, l, "x", 0) for i, (l, t) in enumerate(rows)], "phrase long, text string, lang string, n string, size int")
    result = collocation.collocations(docs, **options)
    assert [f.dataType.simpleString() for f in result.schema] == ["string", "bigint", "string"] + ["bigint"] * 5
    return sorted(tuple(r) for r in result.collect())


def corpus(seed, words, langs, documents=60, length=80):
    rng = random.Random(seed)
    gaps = [" "] * 12 + [". ", ",", "\n", "  ", "\t", " \r\n", "!", "\x0b"]
    rows = []
    for _ in range(documents):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, length)))
        rows.append((rng.choice(langs), text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_counting_every_window(spark, seed):
    words = ["a", "A", "b", "ab", "a\x01", "a\x1f", "\x00", "é", "É", "a-b", "%20", "x|y", "c", "a'", " "]
    rows = corpus(seed, words, ["en", None, "und", "", "a b", "a%20b"])
    assert found(spark, rows, least=3) == brute(rows, 3)
    assert found(spark, rows, least=2, best=5, cover_percent=50) == brute(rows, 2, 5, 50)


def test_one_hot_window_and_many_rare_ones(spark):
    rows = [("en", "the same line again and again")] * 200 + [("en", f"the w{i} of x{i}") for i in range(300)]
    rows += [("en", "the same line"), ("de", "the same line")] * 20
    assert found(spark, rows, least=30) == brute(rows, 30)


def test_edge_texts(spark):
    rows = [(None, None), ("en", ""), ("en", " \t\n"), ("en", "..."), ("en", "one"), ("fr", "a b")]
    assert found(spark, rows, least=1) == brute(rows, 1)
    assert found(spark, rows, least=30) == []
    assert found(spark, [], least=1) == []


def test_a_long_text_is_cut_without_losing_a_window(monkeypatch):
    monkeypatch.setattr(collocation, "BLOCK_BYTES", 16)
    rng = random.Random(3)
    text = "".join(rng.choice(["a ", "bb ", "c. ", "dddddddddddddddddddddddddd ", "e\t"]) for _ in range(400))
    whole = text.encode().replace(b".", b" . ").split()
    windows = [whole[i : i + collocation.LONGEST] for i in range(len(whole))]
    cut = [words[i : i + collocation.LONGEST] for words, own in collocation.word_blocks(text) for i in range(own)]
    assert cut == windows


def test_windows_stop_where_pairs_are_rare():
    words = b"a b c d e . f".split()
    joins = collocation.np.array([True, True, True, False, False, False])
    assert collocation._windows(words, collocation.np.array([0, 1, 2, 3, 4, 6]), joins) == [b"a b c d ", b"b c d ", b"c d ", b"d ", b"e ", b"f "]
    assert collocation._windows(words, collocation.np.arange(0), joins) == []


def test_runs_are_added_over_batches_and_kept_at_the_edges():
    pa = collocation.pa
    rng = random.Random(5)
    counts = Counter("en " + "".join(rng.choice("ab") + " " for _ in range(rng.randint(1, 4))) for _ in range(400))
    ordered = sorted((p.encode(), n) for p, n in counts.items())
    for step in (1, 3, 1000):
        batches = [
            pa.RecordBatch.from_arrays([pa.array([p for p, _ in part], pa.binary()), pa.array([n for _, n in part])], ["phrase", "n"])
            for part in (ordered[i : i + step] for i in range(0, len(ordered), step))
        ]
        got = Counter()
        for batch in collocation._prefix_sums(1)(iter(batches)):
            for phrase, n in zip(batch.column("phrase").to_pylist(), batch.column("n").to_pylist()):
                got[phrase] += n
        expected = Counter()
        for phrase, n in ordered:
            for k in range(1, len(phrase.split()) + 1):
                expected[b" ".join(phrase.split()[:k]) + b" "] += n
        assert got == expected
        few = {r["phrase"] for b in collocation._prefix_sums(60)(iter(batches)) for r in b.to_pylist()}
        assert few >= {p for p, n in expected.items() if n >= 60} and len(few) < len(expected)
