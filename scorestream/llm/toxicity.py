"""Toxicity by a support vector machine over a subsequence string kernel.

Two words are as similar as the letter triples that both contain in order, gaps
allowed: each occurrence weighs DECAY to the power of the letters it spans, up to
SPAN letters, and the kernel is normalised.  A gap, a doubled or an inserted
letter therefore changes a word little.  Words are folded before: case, look-alike
digits, and signs inside a word go, and letters spelled one by one are joined.

Labels belong to documents, insults to single words of their sentences.  A word is
a positive example if it is found in documents labelled 1 beyond chance, a
negative one if not and a document labelled 0 has it.  The machine is trained on both through
Nyström landmarks, then once more with the negative words that it takes most for
insults added.  As the kernel has explicit features it collapses to one weight per
triple.  A logistic curve turns a document's worst word, and number and density of
such words, into a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorestream.llm.frames import in_held_out_fold, keyed_text
from scorestream.workspace import materialize

DECAY = 0.7
SPAN = 7
CHUNK = 24
LETTER_CODES = 32
TRIPLES = LETTER_CODES**3
MEMO = 300_000
DOCS_AT_ONCE = 400
#: A positive word's log odds, less two standard errors, are at least this.
ERRORS, EVIDENCE = 2.0, 1.5
WORDS_AT_ONCE = 4096

LOOK_ALIKES = str.maketrans("013457@$", "oieastas")
SPELLED_OUT = re.compile(r"(?<!\S)[^\W\d_](?:[\s.*_-]+[^\W\d_](?!\w)){2,}")
NOT_LETTERS = re.compile(r"[\W\d_]+")


def fold(word: str) -> str:
    """Letters of a whitespace-free word, look-alikes read as letters if it has any letter."""
    plain = NOT_LETTERS.sub("", word)
    if not plain:
        return ""
    core = word.strip("!?.,;:\"'()[]{}<>#%&*$-_~^+=|/\\")
    return NOT_LETTERS.sub("", core.translate(LOOK_ALIKES)) or plain


def words_of(text: str) -> set[str]:
    """Distinct words of a text in lower case, spelled-out ones joined besides."""
    low = text.lower()
    found = set(low.split())
    found.update(NOT_LETTERS.sub("", run) for run in SPELLED_OUT.findall(low))
    return found


def chunks(word: str) -> list[str]:
    """Overlapping pieces of a long word, so that no part of it goes unread."""
    if len(word) <= CHUNK:
        return [word]
    return [word[at : at + CHUNK] for at in range(0, len(word) - CHUNK // 2, CHUNK // 2)]


def _letters(words: list[str], width: int) -> np.ndarray:
    """Letter codes: a to z from 1, all others shared out over the rest; 0 behind the end."""
    points = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.int64)
    latin = points - 96
    return np.where(points == 0, 0, np.where((latin >= 1) & (latin <= 26), latin, 27 + points % 5))


_SHAPES: dict[int, tuple] = {}


def _triples(width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if width not in _SHAPES:
        found = [
            (i, j, k)
            for i in range(width)
            for j in range(i + 1, width)
            for k in range(j + 1, width)
            if k - i < SPAN
        ]
        i, j, k = np.array(found, np.int64).reshape(-1, 3).T
        _SHAPES[width] = (i, j, k, DECAY ** (k - i + 1.0))
    return _SHAPES[width]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, triple, value) of all words, every row scaled to length one; sorted by row.

    Words of fewer than three letters have no feature.
    """
    order = np.argsort([len(w) for w in words], kind="stable")
    parts = []
    for at in range(0, len(order), WORDS_AT_ONCE):
        rows = order[at : at + WORDS_AT_ONCE]
        here = [words[r] for r in rows]
        letters = _letters(here, max(3, len(here[-1])))
        i, j, k, weight = _triples(letters.shape[1])
        codes = (letters[:, i] * LETTER_CODES + letters[:, j]) * LETTER_CODES + letters[:, k]
        inside = letters[:, k] > 0
        row = np.broadcast_to(rows[:, None], codes.shape)[inside]
        keys, where = np.unique(row * TRIPLES + codes[inside], return_inverse=True)
        values = np.bincount(where, np.broadcast_to(weight, codes.shape)[inside], len(keys))
        parts.append((keys // TRIPLES, keys % TRIPLES, values))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, triple, value = (np.concatenate(x) for x in zip(*parts))
    length = np.sqrt(np.bincount(row, value * value, len(words)))
    value = value / length[row]
    by_row = np.argsort(row, kind="stable")
    return row[by_row], triple[by_row], value[by_row]


def bent(signs: np.ndarray) -> np.ndarray:
    """Signs of documents with their squares, the product of number and density, and a constant."""
    worst, many, dense = signs.T
    return np.stack([worst, many, dense, worst**2, many * dense, dense**2, np.ones(len(signs))], axis=1)


@dataclass
class ToxicWords:
    """One weight per triple, a bias, and the curve that turns a document's signs into a score."""

    weights: np.ndarray
    bias: float
    curve: np.ndarray = field(default_factory=lambda: np.eye(7)[0])
    _memo: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_memo": {}}

    def word_margins(self, words: list[str]) -> np.ndarray:
        row, triple, value = features(words)
        return np.bincount(row, self.weights[triple] * value, len(words)) + self.bias

    def signs(self, texts: list[str]) -> np.ndarray:
        """Per text: margin of the worst word, log of how many are bad, log of their share.

        The bias stands for the worst word where there is none.
        """
        found = [words_of(text) for text in texts]
        if len(self._memo) > MEMO:
            self._memo.clear()
        fresh = list(set().union(*found).difference(self._memo))
        pieces, owner = [], []
        for at, word in enumerate(map(fold, fresh)):
            for piece in chunks(word):
                pieces.append(piece)
                owner.append(at)
        worst = np.full(len(fresh), -np.inf)
        if pieces:
            np.maximum.at(worst, owner, self.word_margins(pieces))
        self._memo.update(zip(fresh, worst.tolist()))
        out = np.empty((len(texts), 3))
        for at, words in enumerate(found):
            margins = np.fromiter(map(self._memo.__getitem__, words), float, len(words))
            bad = np.clip(margins, 0, 1).sum()
            out[at] = margins.max(initial=self.bias), np.log(bad + 0.3), np.log(bad / (len(words) + 10) + 1e-3)
        return out

    def probability(self, signs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(bent(signs) @ self.curve, -500, 500)))


def fit_machine(
    positive: list[str], times: list[int], negative: list[str], landmarks: int, penalty: float = 1e-4
) -> ToxicWords:
    """Squared-hinge machine over Nyström features, classes weighing the same; finite Newton steps."""
    words = positive + negative
    sign = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    often = np.sqrt(np.array(times, float))
    weight = np.r_[often / often.sum(), np.full(len(negative), 1 / len(negative))]
    half = max(1, landmarks // 2)
    marks = positive[:half] + negative[: landmarks - min(half, len(positive))]
    row, triple, value = features(marks)
    known = np.zeros((len(marks), TRIPLES))
    known[row, triple] = value
    spectrum, vectors = np.linalg.eigh(known @ known.T)
    kept = spectrum > 1e-8
    root = vectors[:, kept] / np.sqrt(spectrum[kept])

    row, triple, value = features(words)
    kernel = np.zeros((len(words), len(marks)))
    for at in range(0, len(row), 1 << 16):
        part = slice(at, at + (1 << 16))
        np.add.at(kernel, row[part], value[part, None] * known[:, triple[part]].T)
    design = np.c_[kernel @ root, np.ones(len(words))]
    beta = np.zeros(design.shape[1])
    ridge = penalty * np.eye(len(beta))
    ridge[-1, -1] = 1e-9
    active = np.ones(len(words), bool)
    for _ in range(50):
        z = design[active] * weight[active, None]
        beta = np.linalg.solve(ridge + z.T @ design[active], z.T @ sign[active])
        now = sign * (design @ beta) < 1
        if (now == active).all():
            break
        active = now
    return ToxicWords(known.T @ (root @ beta[:-1]), float(beta[-1]))


def fit_curve(signs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic curve over the signs by Newton's method, with a small penalty."""
    design = bent(signs)
    centre, scale = design[:, :-1].mean(axis=0), design[:, :-1].std(axis=0) + 1e-9
    design[:, :-1] = (design[:, :-1] - centre) / scale
    theta = np.zeros(design.shape[1])
    ridge = np.diag([1e-3 * len(signs) ** 0.5] * (design.shape[1] - 1) + [1e-9])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (p - label) + ridge @ theta
        bend = (design * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ design + ridge
        step = np.linalg.solve(bend, slope)
        step /= max(1, np.abs(step).max())
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    steep = theta[:-1] / scale
    return np.r_[steep, theta[-1] - steep @ centre]


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, int]]:
    """Whole labelled texts outside the held-out fold, about ``most`` of either label at most."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~in_held_out_fold(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    grain = 1_000_000
    share = {label: min(grain, grain * most // n + 1) for label, n in sizes.items()}
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(grain))
    wanted = F.when(F.col("toxic") == 1, share.get(1, 0)).otherwise(share.get(0, 0))
    known = known.where(dealt < wanted)
    texts = docs.where(dealt < max(share.values(), default=0)).dropna(subset=["text"])
    return texts.join(known, "doc_id"), sizes


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            part = batch.slice(at, DOCS_AT_ONCE)
            rows = [
                (i, piece)
                for i, text in enumerate(part.column("text"))
                for piece in {p for w in words_of(text.as_py()) for p in chunks(fold(w)) if len(p) > 2}
            ]
            owners = pa.array([i for i, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(owners), part.column("toxic").take(owners), pa.array([p for _, p in rows], pa.string())],
                ["doc_id", "toxic", "word"],
            )


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample_documents: int = 3000,
    sample_words: int = 12_000,
    hard_words: int = 2000,
    landmarks: int = 256,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> ToxicWords | float:
    """Train on at most about ``sample_documents`` documents of either label, outside the held-out fold.

    Documents are chosen by a hash of their id and read whole; of their words
    ``sample_words`` negative ones, chosen by hash, the ``hard_words`` negative
    ones of highest margin, and all positive ones up to ``sample_words`` reach
    the driver.  Without both labels, or without a word that
    tells them apart, the share of label 1 is returned for a score.
    """
    texts, sizes = _sample(keyed_text(docs, id_column, text_column), labels, sample_documents)
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return prior
    texts = materialize(texts.select("doc_id", "toxic", "text"), "toxic-sample")
    kind = texts.schema["doc_id"].dataType.simpleString()
    words = materialize(texts.mapInArrow(_words, f"doc_id {kind}, toxic int, word string"), "toxic-words")
    ones, zeros = (texts.where(F.col("toxic") == label).count() for label in (1, 0))
    if not ones or not zeros:
        return prior
    counted = words.groupBy("word").agg(
        F.sum("toxic").alias("in_ones"), F.sum(1 - F.col("toxic")).alias("in_zeros")
    )
    ones_with, zeros_with = F.col("in_ones") + 0.5, F.col("in_zeros") + 0.5
    odds = F.log(ones_with / (ones + 1)) - F.log(zeros_with / (zeros + 1))
    error = F.sqrt(1 / ones_with + 1 / zeros_with)
    counted = materialize(counted.withColumn("certain", odds - ERRORS * error), "toxic-evidence")
    positive = counted.where(F.col("certain") >= EVIDENCE).orderBy(F.desc("certain"), "word").limit(sample_words)
    positive = positive.select("word", "in_ones").collect()
    harmless = counted.where((F.col("in_zeros") > 0) & (F.col("certain") < EVIDENCE)).select("word")
    negative = harmless.orderBy(F.xxhash64("word"), "word").limit(sample_words).collect()
    if not positive or not negative:
        return prior
    insults, times = [r["word"] for r in positive], [r["in_ones"] for r in positive]
    easy = [r["word"] for r in negative]
    machine = fit_machine(insults, times, easy, landmarks)
    mistaken = _word_margins(harmless, machine).where(F.col("margin") > 0)
    hard = [r["word"] for r in mistaken.orderBy(F.desc("margin"), "word").limit(hard_words).collect()]
    if hard:
        machine = fit_machine(insults, times, list(dict.fromkeys(hard + easy)), landmarks)
    judged = _judged(texts.select("doc_id", "text"), machine).join(texts.select("doc_id", "toxic").distinct(), "doc_id")
    judged = judged.toArrow()
    signs = np.stack([judged.column(c).to_numpy() for c in ("worst", "many", "dense")], axis=1)
    machine.curve = fit_curve(signs, judged.column("toxic").to_numpy().astype(float))
    return machine


def _word_margins(words: DataFrame, machine: ToxicWords) -> DataFrame:
    """(word, margin) of folded words."""
    shared = words.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = shared.value.word_margins(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(margins)], ["word", "margin"])

    return words.mapInArrow(run, "word string, margin double")


def _judged(texts: DataFrame, machine: ToxicWords) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                signs = own.signs([text or "" for text in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, signs.T.copy()), pa.array(own.probability(signs))],
                    ["doc_id", "worst", "many", "dense", "score"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, worst double, many double, dense double, score double")


def score_toxicity(
    docs: DataFrame, machine: ToxicWords | float, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, score, predicted), one row per document; null and empty texts have the score of the bias."""
    rows = keyed_text(docs, id_column, text_column)
    if isinstance(machine, float):
        scored = rows.select("doc_id", F.lit(machine).alias("score"))
    else:
        scored = _judged(rows, machine).select("doc_id", "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
