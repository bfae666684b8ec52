import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from scorestream.llm import tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

TEXTS = [
    "", " ", "Hello world's \n\n  x", "naïve façade ÄÖÜ 東京 🎉🎉", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 5000,
    "é" * 500, "12345678 9.5%", "\x00\x1c\x85 　", "▁ <unk> <s>", "ab " * 400,
]


@pytest.fixture(scope="module")
def library():
    ranks = {token: i for i, token in enumerate(tokens.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(count):
    rng = random.Random(7)
    alphabet = list(" \n\t'.,!?abcdefgstlmrdv0123éñ東🎉 ") + ["the", " and", "'ll"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(count)]


def test_counts_equal_the_library(spark):
    texts = TEXTS + random_texts(300)
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(0, "", 1), (None, "a b", 1), (-1, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    reference = Tokenizer.from_file(JSON)
    expected = sorted(
        (str(i), len((t or "").encode()), n := len(reference.encode(t or "", add_special_tokens=False).ids), n > 1024)
        for i, t, _ in rows
    )
    found = tokens.count_tokens(docs, JSON, PATTERN)
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == expected
    assert tokens.count_tokens(docs.limit(0), JSON, PATTERN).count() == 0


def test_the_proof_covers_only_strings_of_one_token():
    rules = tokens.MergeRules(JSON)
    whole = rules.whole_tokens()
    assert whole <= set(rules.vocabulary)
    assert all(rules.merged(piece) == 1 for piece in list(whole)[::500])
    rules.rank = {pair: at for pair, at in rules.rank.items() if pair != ("t", "h")}
    assert "th" not in rules.whole_tokens()


def test_a_full_memo_changes_no_count(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 3)
    rules = tokens.MergeRules(JSON)
    small = tokens.TokenCounter(rules, rules.whole_tokens(), PATTERN)
    reference = Tokenizer.from_file(JSON)
    for text in random_texts(50):
        assert small.count(text) == len(reference.encode(text, add_special_tokens=False).ids)


def test_ids_equal_the_library_and_decode_to_the_text(spark, library):
    texts = TEXTS + random_texts(300)
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, None), (None, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {str(r["doc_id"]): r for r in tokens.encode_decode(docs, RANKS, PATTERN).collect()}
    digested = {str(r["doc_id"]): r for r in tokens.encode_decode(docs, RANKS, PATTERN, digests=True).collect()}
    for i, text in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        row, short = found[str(i)], digested[str(i)]
        assert (row["n_tokens"], bytes(row["ids"]), bytes(row["decoded"])) == (len(ids) // 4, ids, (text or "").encode())
        assert short["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert short["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert tokens.encode_decode(docs.limit(0), RANKS, PATTERN).count() == 0


def test_the_written_model_has_every_token_by_negative_rank():
    own = tokens.read_ranks(RANKS)
    model = tokens.piece_model(own)
    assert tokens.inverse_tokens(model) == own
    loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert loaded.get_score(1001) == -1000.0 and loaded.unk_id() == 0 and loaded.bos_id() == -1


def test_codes_replace_the_text_and_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b", "x y"), (2, None, None)], "doc_id long, text string, `odd name` string")
    found = tokens.with_codes(docs, RANKS, PATTERN).orderBy("doc_id").collect()
    assert found[0]["odd name"] == "x y" and found[0]["n_tokens"] == len(found[0]["ids"]) == 2
    assert found[1]["ids"] == [] and found[1]["round_trip"]


def test_the_longest_special_string_counts():
    rules = tokens.MergeRules(JSON)
    rules.special = ["<a>", "<a><b>", "<b>"]
    assert tokens.TokenCounter(rules, frozenset(), PATTERN).count("<a><b><a>") == 2
