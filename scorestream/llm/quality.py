"""Quality by hashed word n-grams and a logistic regression trained by FTRL.

A text is a sparse vector: words, pairs of neighbouring words and the forms of
words (case and closing marks) are hashed to one of ``buckets`` places; a place
holds the logarithm of how often it was met, and the vector has length one.  Follow the
regularised leader, coordinate by coordinate, goes over the labelled sample; a
score is the sparse dot product of text and weights, put through the logistic
curve.  The weights take eight bytes a bucket, whatever the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorestream.llm.frames import keyed_text
from scorestream.workspace import materialize

BUCKETS = 1 << 18
MEMO = 300_000
ROWS_AT_ONCE = 256
#: Characters of a text that are cut into words at once.
BLOCK_CHARS = 1 << 20
FOLDS, HELD_OUT = 3, 1

_MARKS = re.compile(r"[\W_]*$")
_NEXT, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def in_held_out_third(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


class _Codes(dict):
    """Two hashes of a word: of itself in lower case, and of its form (case, and the marks it ends in)."""

    def __missing__(self, word: str) -> tuple[int, int]:
        marks = _MARKS.search(word).group()
        letters = word[: len(word) - len(marks)]
        case = "upper" if len(letters) > 1 and letters.isupper() else "title" if letters[:1].isupper() else "lower"
        found = tuple(
            xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) for s in (word.lower(), f"{case} {marks[:8]}")
        )
        self[word] = found
        return found


def _blocks(text: str) -> Iterator[list[str]]:
    """Words of a text, a bounded number of characters at a time; the last word is repeated at the next head."""
    if len(text) <= BLOCK_CHARS:
        yield text.split()
        return
    last: list[str] = []
    at = 0
    while at < len(text):
        end = min(at + BLOCK_CHARS, len(text))
        while end < len(text) and not text[end].isspace():
            end += 1
        words = last + text[at:end].split()
        yield words
        last, at = words[-1:], end


def sparse(text: str | None, buckets: int, codes: dict) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text: log counts of hashed words, word pairs and word forms, at length one."""
    places: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for number, words in enumerate(_blocks(text or "")):
        if not words:
            continue
        found = np.array(list(map(codes.__getitem__, words)), np.uint64)
        pairs = found[:-1] * _NEXT + found[1:]
        hashes = np.concatenate([found[number > 0 :].ravel(), pairs.ravel()])
        hashes ^= hashes >> np.uint64(31)
        hashes *= _SPREAD
        place, n = np.unique((hashes >> np.uint64(20)) % np.uint64(buckets), return_counts=True)
        places.append(place.astype(np.int64))
        counts.append(n)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0)
    if len(places) > 1:
        place, back = np.unique(np.concatenate(places), return_inverse=True)
        total = np.bincount(back, np.concatenate(counts))
    else:
        place, total = places[0], counts[0]
    value = 1 + np.log(total)
    return place, value / np.sqrt((value * value).sum())


@dataclass
class Leader:
    """State and update of follow the regularised leader, one learning rate per coordinate."""

    buckets: int
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def __post_init__(self):
        self.z = np.zeros(self.buckets + 1)
        self.n = np.zeros(self.buckets + 1)

    def weights_at(self, places: np.ndarray) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - np.where(places == self.buckets, 0, self.l1), 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, places: np.ndarray, values: np.ndarray, label: int, weight: float = 1.0) -> None:
        """One labelled row; the last place is the bias, which is not shrunk by ``l1``."""
        places, values = np.append(places, self.buckets), np.append(values, 1.0)
        now = self.weights_at(places)
        slope = weight * (logistic(now @ values) - label) * values
        step = (np.sqrt(self.n[places] + slope * slope) - np.sqrt(self.n[places])) / self.alpha
        self.z[places] += slope - step * now
        self.n[places] += slope * slope

    def weights(self) -> np.ndarray:
        return self.weights_at(np.arange(self.buckets + 1))


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class QualityModel:
    """Weights per bucket, the bias last."""

    weights: np.ndarray

    def score(self, text: str | None, codes: dict) -> float:
        places, values = sparse(text, len(self.weights) - 1, codes)
        return float(logistic(values @ self.weights[places] + self.weights[-1]))


def _sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[DataFrame, dict[int, int]]:
    """Whole labelled texts outside the held-out third, about ``most`` of either label, chosen by hash."""
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~in_held_out_third(F.col("doc_id"))
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    grain = 1_000_000
    share = {value: min(grain, grain * most // n + 1) for value, n in sizes.items()}
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(grain))
    wanted = F.when(F.col("label") == 1, share.get(1, 0)).otherwise(share.get(0, 0))
    known = known.where(dealt < wanted)
    texts = docs.where(dealt < max(share.values(), default=0))
    return texts.join(known, "doc_id"), sizes


def _sparse_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = []
                for text in part.column("text"):
                    if len(codes) > MEMO:
                        codes.clear()
                    rows.append(sparse(text.as_py(), buckets, codes))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("label"),
                        pa.array([places for places, _ in rows], pa.list_(pa.int64())),
                        pa.array([values for _, values in rows], pa.list_(pa.float64())),
                    ],
                    ["key", "label", "places", "values"],
                )

    return run


def _lead(buckets: int, settings: dict, share: dict[int, int]):
    """Goes over sparse rows one by one and returns the weights that are not zero."""
    weight = {value: sum(share.values()) / (2 * n) for value, n in share.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = Leader(buckets, **settings)
        for batch in batches:
            for label, places, values in zip(*(batch.column(c) for c in ("label", "places", "values"))):
                label = label.as_py()
                leader.update(places.values.to_numpy(), values.values.to_numpy(), label, weight[label])
        found = leader.weights()
        kept = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(found[kept])], ["place", "weight"])

    return run


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_documents: int = 2000,
    buckets: int = BUCKETS,
    epochs: int = 3,
    settings: dict | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> QualityModel | float:
    """Train on about ``sample_documents`` documents of either label at most, outside the held-out third.

    The documents are chosen by a hash of their id and read whole; both labels
    weigh the same.  Their sparse rows are made in parallel and written; one task
    goes over them row by row, ``epochs`` times in orders of their own, as the
    method asks; only the weights reach the driver.  An id with both labels counts as 1.  Without rows of both labels
    the share of label 1 is returned for a score (one half without any).
    """
    texts, sizes = _sample(keyed_text(docs, id_column, text_column), labels, label, sample_documents)
    if len(sizes) < 2:
        return float(next(iter(sizes), 0.5))
    kind = "key long, label int, places array<long>, values array<double>"
    rows = texts.select(F.xxhash64("doc_id", "text").alias("key"), "label", "text").mapInArrow(_sparse_rows(buckets), kind)
    rows = materialize(rows, "quality-sample")
    share = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        return sizes.get(1, 0) / sum(sizes.values())
    passes = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    passes = passes.repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "key"), "key")
    found = passes.mapInArrow(_lead(buckets, settings or {}, share), "place long, weight double").toArrow()
    weights = np.zeros(buckets + 1)
    weights[found.column("place").to_numpy()] = found.column("weight").to_numpy()
    return QualityModel(weights)


def score_quality(
    docs: DataFrame, model: QualityModel | float, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, score, predicted), one row per document, whole texts.

    Null, empty and blank texts have the score of the bias; rows with a null id
    are scored like any other, repeated rows each; further columns are not read.
    """
    rows = keyed_text(docs, id_column, text_column)
    if isinstance(model, float):
        scored = rows.select("doc_id", F.lit(model).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        kind = rows.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes = _Codes()
            for batch in batches:
                scores = np.empty(batch.num_rows)
                for row, text in enumerate(batch.column("text")):
                    if len(codes) > MEMO:
                        codes.clear()
                    scores[row] = shared.value.score(text.as_py(), codes)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

        scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
