"""Divergences against whole-number arithmetic in Python, with small blocks on every axis."""

import random
import re
from collections import Counter, defaultdict

import pytest

from scorestream.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, best=200):
    count, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        count[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, d in seen[lang].items() if d >= least)
        own = {s: {t: count[lang, s][t] for t in kept} for s in sources}
        total = {t: sum(own[s][t] for s in sources) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(own[s]) for s in sources}, share(total)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            parts = {
                "pair": [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s],
                "term": [(t, f(p[s][t], q[t])) for t in kept if own[s][t] and p[s][t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items, 1) if part == "pair" or r <= best]
    return sorted(out)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, term int, share string")
    return sorted(tuple(r) for r in divergence.divergence_audit(docs, **options).collect())


def corpus(seed, sources=9, documents=70):
    rng = random.Random(seed)
    words = ["a", "A", "bé", "É", "c_d", "e1f", " ", "g" * 40, "h-i"] + [f"w{chr(97 + i)}" for i in range(26)]
    names = ["", None, "é", "s b", "S"] + [f"src{i}" for i in range(sources)]
    rows = []
    for _ in range(documents):
        lang = rng.choice(["en", "en", "de", None, ""])
        text = " ".join(rng.choice(words[: rng.randint(1, len(words))]) for _ in range(rng.randint(0, 40)))
        rows.append((lang, rng.choice(names), rng.choice([text] * 9 + [None])))
    return rows


@pytest.mark.parametrize(("group_block", "term_block"), [(48, 20_000), (2, 5), (1, 1)])
def test_every_cut_of_the_cube_gives_the_same_sums(spark, group_block, term_block):
    rows = corpus(group_block)
    assert found(spark, rows, group_block=group_block, term_block=term_block) == brute(rows)


def test_sources_without_terms_and_languages_without_kept_ones(spark):
    rows = [("en", "a", None), ("en", "b", "12 34"), ("en", "c", "")] + [("de", "a", "ja nein"), ("de", "b", "ja")]
    rows += [("fr", "only", "un deux"), ("fr", "only", "un deux"), ("fr", "only", "un")]
    result = found(spark, rows)
    assert result == brute(rows) and {r[4] for r in result if r[0] in ("en", "de")} == {0}
    assert found(spark, []) == []


def test_a_few_ranks_only_for_terms(spark):
    rows = corpus(3)
    assert found(spark, rows, best_terms=2, least_documents=1) == brute(rows, 1, 2)


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, terms = 4_000_000_000_000_000, 7_000_000_000_000_011, 13
    got = spark.range(1).select(divergence._share(divergence.F.lit(n), divergence.F.lit(total), divergence.F.lit(terms))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + terms)


def test_a_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 8)
    text = "Ab cd" * 30 + " " + "x" * 50 + "1é2 y"
    assert [t for block in divergence.text_terms(text) for t in block] == [
        t.encode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
    ]
