"""Token counts and byte-level BPE over public vocabulary files.

``count_tokens`` takes the whole-token shortcut: which vocabulary strings encode
alone as one token is proved beforehand by running the merges on each of them;
a pre-token among these counts 1 without further work, and only the rest is
merged.  ``encode_decode`` writes a sentencepiece BPE model straight from the
ranks, encodes pre-tokens with it, and decodes by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorestream.llm.frames import capped_cache, keyed_text, texts_of

CACHED = 400_000
CACHED_CHARS = 40
LIMIT = 1024
ROWS_AT_ONCE = 500


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the characters
    from 256 on, in order.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


LETTERS = byte_letters()
TO_LETTERS = {b: LETTERS[b] for b in range(256)}
BYTE_OF = {letter: b for b, letter in enumerate(LETTERS)}


def spelled(piece: str) -> str:
    """UTF-8 bytes of a text, one letter for each."""
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(TO_LETTERS)


class MergeRules:
    """Ranked merges of a byte-level vocabulary in the tokenizers library's JSON form."""

    def __init__(self, path: str):
        described = json.loads(Path(path).read_text(encoding="utf-8"))
        model = described["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: at for at, pair in enumerate(pairs)}
        self.vocabulary = list(model["vocab"])
        self.special = [t["content"] for t in described["added_tokens"]]

    def merged(self, letters: str) -> int:
        """How many tokens the merges leave of one pre-token.

        The pair of lowest rank merges first, the leftmost of equals; a heap over
        a linked list keeps that within n log n for pre-tokens of any length.
        """
        parts: list[str | None] = list(letters)
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank = self.rank.get
        heap = [
            (order, i, parts[i], parts[i + 1])
            for i in range(size - 1)
            if (order := rank((parts[i], parts[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        left = size
        while heap:
            _, i, first, second = heapq.heappop(heap)
            j = after[i]
            if parts[i] != first or j >= size or parts[j] != second:
                continue
            parts[i], parts[j] = first + second, None
            left -= 1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                if (order := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (order, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (order := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (order, h, parts[h], parts[i]))
        return left

    def whole_tokens(self) -> frozenset[str]:
        """Vocabulary strings, spelled in letters, that the merges turn into one token."""
        return frozenset(piece for piece in self.vocabulary if piece and self.merged(piece) == 1)


class TokenCounter:
    """Counts the tokens of texts; remembers short pre-tokens up to a bound."""

    def __init__(self, rules: MergeRules, whole: frozenset[str], pattern: str):
        self.rules = rules
        self.find = regex.compile(pattern).findall
        special = sorted(rules.special, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, special))).split if special else None
        self.whole = {
            text: 1
            for piece in whole
            if (text := bytes(BYTE_OF[c] for c in piece).decode("utf-8", "replace")).find("�") < 0
        }
        self.known = self._memo()

    def _memo(self):
        rules = self.rules

        class Memo(dict):
            def __missing__(self, piece: str) -> int:
                n = rules.merged(spelled(piece))
                if len(piece) <= CACHED_CHARS:
                    self[piece] = n
                return n

        return Memo(self.whole)

    def count(self, text: str) -> int:
        if len(self.known) > len(self.whole) + CACHED:
            self.known = self._memo()
        known = self.known
        parts = self.split(text) if self.split else [text]
        return len(parts) - 1 + sum(sum(map(known.__getitem__, self.find(part))) for part in parts)


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per document; a null text is empty.

    A special token's string inside a text is that token, as the library has it
    by default.  The proof runs once, on the driver; its result is at most the
    vocabulary and goes to the executors as a broadcast.
    """
    rules = MergeRules(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((rules, rules.whole_tokens()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(*shared.value, pattern)
        for batch in batches:
            n = np.fromiter(map(counter.count, texts_of(batch)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = keyed_text(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    ).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of base64 token and rank, one pair a line."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out + bytes([value]))


def _field(number: int, value: int | bytes | str) -> bytes:
    """One field of a protocol-buffer message: a number or a length-delimited value."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    raw = value.encode("utf-8") if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


# Fixed values of the published sentencepiece model format: field numbers and enumerations.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TYPE_NORMAL, TYPE_UNKNOWN = 1, 2
TRAINER_MODEL_TYPE, MODEL_BPE, TRAINER_UNK_ID, TRAINER_BOS_ID, TRAINER_EOS_ID, TRAINER_PAD_ID = 3, 2, 40, 41, 42, 43
NORMALIZER_NAME, NORMALIZER_DUMMY_PREFIX, NORMALIZER_TRIM, NORMALIZER_ESCAPE = 1, 3, 4, 5
NO_ID = (1 << 64) - 1


def piece_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model: the unknown piece, then every token scored by minus its rank."""

    def piece(text: str, score: float, kind: int) -> bytes:
        score_field = _varint(PIECE_SCORE << 3 | 5) + np.float32(score).tobytes()
        return _field(PIECES, _field(PIECE_TEXT, text) + score_field + _field(PIECE_TYPE, kind))

    out = [piece("<unk>", 0.0, TYPE_UNKNOWN)]
    for rank, token in enumerate(tokens):
        out.append(piece("".join(LETTERS[b] for b in token), -float(rank), TYPE_NORMAL))
    trainer = [(TRAINER_MODEL_TYPE, MODEL_BPE), (TRAINER_UNK_ID, 0)]
    trainer += [(k, NO_ID) for k in (TRAINER_BOS_ID, TRAINER_EOS_ID, TRAINER_PAD_ID)]
    out.append(_field(TRAINER, b"".join(_field(k, v) for k, v in trainer)))
    plain = [(NORMALIZER_DUMMY_PREFIX, 0), (NORMALIZER_TRIM, 0), (NORMALIZER_ESCAPE, 0)]
    out.append(_field(NORMALIZER, b"".join(_field(k, v) for k, v in [(NORMALIZER_NAME, "identity"), *plain])))
    return b"".join(out)


class PieceCodec:
    """Encodes and decodes texts with a serialised piece model."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        self.tokens = tokens
        self.find = regex.compile(pattern).findall
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rank_of = {token: rank for rank, token in enumerate(tokens)}
        self.known = self._memo()

    def _memo(self):
        one = self._encode_one

        class Memo(dict):
            def __missing__(self, piece: str) -> bytes:
                ids = one(piece)
                if len(piece) <= CACHED_CHARS:
                    self[piece] = ids
                return ids

        return Memo()

    def _encode_one(self, piece: str) -> bytes:
        """Ids of one pre-token, 32 bits each; a pre-token that is itself a token is that token."""
        rank = self.rank_of.get(piece.encode("utf-8"))
        if rank is not None:
            return np.uint32(rank).tobytes()
        return (np.array(self.pieces.encode(spelled(piece)), np.int64) - 1).astype("<u4").tobytes()

    def encode(self, text: str) -> bytes:
        capped_cache(self.known, CACHED)
        return b"".join(map(self.known.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, by the inverse of the mapping that spelled them."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def inverse_tokens(model: bytes) -> list[bytes]:
    """Token bytes by rank, read back out of a serialised piece model."""
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    spelled_pieces = (pieces.id_to_piece(i) for i in range(1, pieces.get_piece_size()))
    return [bytes(BYTE_OF[c] for c in piece) for piece in spelled_pieces]


CODES = "doc_id {}, n_tokens long, ids binary, decoded binary"
DIGESTS = "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    digests: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): token ids as little-endian 32-bit numbers, and their text.

    With ``digests``, the SHA-256 of both instead, so that the ids need not leave
    the worker.  A null text is empty.
    """
    model = piece_model(read_ranks(ranks))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(inverse_tokens(shared.value), shared.value, pattern)
        for batch in batches:
            counts, first, second = [], [], []
            for text in texts_of(batch):
                ids = codec.encode(text)
                decoded = codec.decode(ids)
                counts.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest() if digests else ids)
                second.append(hashlib.sha256(decoded).hexdigest() if digests else decoded)
            kind = pa.string() if digests else pa.binary()
            names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(first, kind), pa.array(second, kind)],
                ["doc_id", "n_tokens", *names],
            )

    rows = keyed_text(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, (DIGESTS if digests else CODES).format(kind))


def with_codes(docs: DataFrame, ranks: str, pattern: str, text_column: str = "text") -> DataFrame:
    """All columns but the text, then n_tokens, ids (array) and whether decoding gives the text again.

    A null text is empty.
    """
    model = piece_model(read_ranks(ranks))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [name for name in docs.columns if name != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(inverse_tokens(shared.value), shared.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                codes, right = [], []
                for text in texts_of(part, text_column):
                    codes.append(codec.encode(text))
                    right.append(codec.decode(codes[-1]) == text.encode("utf-8"))
                sizes = np.array([len(ids) // 4 for ids in codes], np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(bounds, np.frombuffer(b"".join(codes), "<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in kept), pa.array(sizes), ids, pa.array(right)],
                    [*kept, "n_tokens", "ids", "round_trip"],
                )

    fields = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in kept)
    return docs.mapInArrow(run, f"{fields}, n_tokens long, ids array<int>, round_trip boolean")
