import hashlib
import random
import re

import numpy as np
import pytest

from scorestream.llm import private

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and checksum(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["@", ".", "a", "b", "1", "29", "255", "+", "-", " ", "(", ")", "4111 1111 1111 1111", "x.y", "\n", "%", "1.2.3.4", "é", "🎉", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert private.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 90_000, "+1" * 90_000, "a@" * 50_000, "1 " * 90_000, "+" + " " * 200_000])
def test_long_runs_are_read_in_one_go(text):
    private.nodes_of(text, private.base_spans(text))


@pytest.fixture(scope="module")
def field(spark):
    return private.fit_field(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_a_number_is_known_again_without_its_prefix(field):
    text = "Call +1 (132) 555-1352 now, later (132) 555-1352. Order 5551352 9 and 20240105 came. Write a.b@c.de or a.b@local"
    base = private.base_spans(text)
    (added,) = field.added([private.nodes_of(text, base)])
    assert {(text[s:e], private.KINDS[k]) for s, k, e in added} >= {("(132) 555-1352", "phone"), ("a.b@local", "email")}
    assert not any(text[s:e] == "20240105" for s, _, e in added)
    assert field.added([private.nodes_of("20240105 and 4111111111111112", [])]) == [[]]


@pytest.mark.parametrize("first", [True, False])
def test_a_number_is_known_again_however_often_it_stands(field, first):
    bare = " ".join(f"Later, in part {'abcdefghij'[i % 10]} of the long report, call (132) 555-1352 again." for i in range(100))
    text = " ".join(["Call +1 (132) 555-1352 now.", bare] if first else [bare, "Call +1 (132) 555-1352 now."])
    (added,) = field.added([private.nodes_of(text, private.base_spans(text))])
    assert len(added) == 100 and {(text[s:e], private.KINDS[k]) for s, k, e in added} == {("(132) 555-1352", "phone")}
    other = "x 20240105 y " * 3
    assert field.added([private.nodes_of(t, private.base_spans(t)) for t in (other, text)]) == [[], added]
    assert field.added([private.nodes_of(bare, [])]) == [[]]


def test_marginals_on_a_chain_equal_enumeration(field):
    rng = np.random.default_rng(1)
    unary = rng.normal(size=(4, private.LABELS))
    near, skip = np.array([[0, 1], [2, 3]]), np.array([[1, 2]])
    found = field.marginals(unary, near, skip)
    exact = np.zeros_like(unary)
    for labels in np.ndindex(*[private.LABELS] * 4):
        score = sum(unary[i, k] for i, k in enumerate(labels))
        score += field.near[labels[0], labels[1]] + field.near[labels[2], labels[3]] + field.skip[labels[1], labels[2]]
        for i, k in enumerate(labels):
            exact[i, k] += np.exp(score)
    assert np.allclose(found, exact / exact.sum(axis=1, keepdims=True), atol=1e-3)


def test_a_graph_grows_with_its_text_only():
    nodes = private.nodes_of("5551352999 " * 3000, [])
    near, skip = private.links_of(nodes)
    assert len(near) + len(skip) <= 4 * len(nodes)


def test_a_graph_with_hubs_grows_with_its_text_only():
    nodes = private.nodes_of("5551352999 " * 3000, [])
    near, skip, hubs, seen_near, seen_skip = private.graph_of(nodes)
    assert len(near) + len(skip) + hubs + len(seen_near) + len(seen_skip) <= 4 * len(nodes)


def test_documents_with_edge_cases(spark, field):
    rows = [(1, None, 1), (2, "", 1), (3, "a@b.co 🎉 +1 (132) 555-1352 1.2.3.4", 1), (3, "a@b.co", 1), (None, "4111 1111 1111 1111", 1), (4, "x" * 300_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_email int")
    found = private.find_private(docs, field).collect()
    assert len(found) == len(rows)
    expected = sorted(hashlib.sha256(private.written(brute(t or "")).encode()).hexdigest() for _, t, _ in rows)
    assert sorted(r["base_sha256"] for r in found) == expected
    whole = next(r for r in found if r["doc_id"] == 3 and r["n_ip"])
    assert whole["spans"] == "email:0:6,phone:9:34,ip:27:34"
    assert private.find_private(docs.limit(0), field).count() == 0
    assert private.fit_field(docs.limit(0)).weights == {}


def test_redaction_keeps_rows_and_columns(spark, field):
    docs = spark.createDataFrame([(1, None, "x"), (2, "mail a@b.co now", "y"), (3, "plain", "z")], "doc_id long, text string, spans string")
    assert sorted(map(tuple, private.redact(docs, field).collect())) == [(1, None, "x"), (2, "mail [EMAIL] now", "y"), (3, "plain", "z")]
    assert private.redacted("0123456789", [(1, 2, 5), (3, 3, 7), (8, 1, 9)]) == "0[CARD]7[IP]9"
