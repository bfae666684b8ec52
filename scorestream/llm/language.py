"""Language identification by prediction by partial matching over bytes.

Every language has a context tree of up to four preceding bytes with counts of
the byte that follows (escape method C, with exclusion).  The statistics are
frozen after training, so a tree is a table of code lengths: one row per context,
one column per byte.  A text belongs to the language whose tree codes it in the
fewest bits.  The alphabet is all 256 byte values; those that no training text
holds are coded alike in every context, so they share a column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorestream.llm.frames import byte_buffers, in_held_out_fold, keyed_text

SYMBOLS = 256
#: Most preceding bytes of a context.
ORDER = 4
BLANK = 32
UNDETERMINED = "und"
WINDOW = 1 << 19
UNIFORM_BITS = float(np.log2(SYMBOLS))
#: Contexts whose code lengths are worked out at once.
CONTEXTS_AT_ONCE = 8192


def surroundings(raw: np.ndarray, bounds: np.ndarray, start: int, stop: int) -> list[np.ndarray]:
    """The bytes at positions start..stop, then those one, two, ... ORDER places before them.

    A text begins after blanks, whatever stands before it in the buffer.
    """
    lead = min(ORDER, start)
    padded = np.concatenate([np.full(ORDER - lead, BLANK, np.uint8), raw[start - lead : stop]])
    size = stop - start
    first, last = np.searchsorted(bounds[:-1], [start - ORDER, stop])
    begins = bounds[first:last]
    found = [padded[ORDER:]]
    for back in range(1, ORDER + 1):
        before = padded[ORDER - back : ORDER - back + size].copy()
        for ahead in range(back):
            inside = begins + ahead
            inside = inside[(inside >= start) & (inside < stop)]
            before[inside - start] = BLANK
        found.append(before)
    return found


@dataclass
class CodeTable:
    """One unfolded tree.

    ``longer[k]`` leads from a context of k bytes and the byte before it to the
    context of k + 1 bytes, each numbered from 1 within its length; 0 stands for
    one never seen.  ``bases[k]`` is added to find its row in ``lengths``.
    """

    longer: list[np.ndarray]
    bases: list[int]
    lengths: np.ndarray

    def cost(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bits of every position, coded in its longest context that was seen."""
        width = self.lengths.shape[1]
        row = np.zeros(len(columns[0]), np.int64)
        state = np.ones(len(columns[0]), np.int64)
        for k, steps in enumerate(self.longer):
            state = steps.ravel()[state * width + columns[k + 1]].astype(np.int64)
            row = np.where(state > 0, state + self.bases[k + 1], row)
        return self.lengths.ravel()[row * width + columns[0]]


@dataclass
class ContextTrees:
    """Code lengths of several languages over the same alphabet.

    ``counts`` holds, per language, the codes seen in training (a byte and those
    before it, the nearest lowest) and how often.  Tables are unfolded on first
    use in a process.
    """

    languages: list[str]
    counts: list[tuple[np.ndarray, np.ndarray]]
    _tables: list = field(default_factory=list, repr=False)

    def alphabet(self) -> np.ndarray:
        """Column of each byte value: 0 for those that no training text holds."""
        seen = np.zeros(SYMBOLS, bool)
        seen[BLANK] = True
        for codes, _ in self.counts:
            seen[codes & (SYMBOLS - 1)] = True
        return np.where(seen, np.cumsum(seen), 0)

    def tables(self) -> list[CodeTable]:
        if not self._tables:
            columns = self.alphabet()
            self._tables = [unfolded(*c, columns) for c in self.counts]
        return self._tables

    def bits(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Code length in bits of each text (rows) under each language (columns)."""
        total = np.zeros((len(bounds) - 1, len(self.languages)))
        alphabet = self.alphabet()
        for start in range(0, len(raw), WINDOW):
            stop = min(start + WINDOW, len(raw))
            columns = [alphabet[part] for part in surroundings(raw, bounds, start, stop)]
            first = np.searchsorted(bounds, start, "right") - 1
            last = np.searchsorted(bounds, stop, "left")
            cuts = np.clip(bounds[first:last], start, stop) - start
            full = np.flatnonzero(np.diff(np.append(cuts, stop - start)))
            for column, table in enumerate(self.tables()):
                total[first + full, column] += np.add.reduceat(table.cost(columns), cuts[full], dtype=np.float64)
        return total

    def __getstate__(self):
        return {"languages": self.languages, "counts": self.counts, "_tables": []}


def unfolded(codes: np.ndarray, counts: np.ndarray, columns: np.ndarray) -> CodeTable:
    """Code lengths of every byte in every context seen, by escapes to ever shorter contexts."""
    width = int(columns.max()) + 1
    contexts, parents, follow, longer, bases = [], [], [], [], []
    for k in range(ORDER + 1):
        seen, where = np.unique((codes >> 8) & (256**k - 1), return_inverse=True)
        own = np.zeros((len(seen), width), np.float32)
        np.add.at(own, (where, columns[codes & 255]), counts)
        parent = np.searchsorted(contexts[-1], seen & (256 ** (k - 1) - 1)) if k else np.zeros(1, np.int64)
        if k:
            steps = np.zeros((len(contexts[-1]) + 1, width), np.int32)
            steps[parent + 1, columns[seen >> (8 * (k - 1))]] = np.arange(1, len(seen) + 1)
            longer.append(steps)
        bases.append(sum(map(len, contexts)) - 1)
        contexts.append(seen)
        parents.append(parent)
        follow.append(own)
    lengths = np.zeros((sum(map(len, contexts)), width), np.float32)
    for k in range(ORDER + 1):
        for at in range(0, len(contexts[k]), CONTEXTS_AT_ONCE):
            rows = np.arange(at, min(at + CONTEXTS_AT_ONCE, len(contexts[k])))
            lengths[bases[k] + 1 + rows] = _lengths(rows, k, follow, parents)
    return CodeTable(longer, bases, lengths)


def _lengths(rows: np.ndarray, order: int, follow: list[np.ndarray], parents: list[np.ndarray]) -> np.ndarray:
    bits = np.zeros((len(rows), follow[0].shape[1]), np.float32)
    spent = np.zeros(len(rows), np.float32)
    coded = np.zeros(bits.shape, bool)
    for depth in range(order, -1, -1):
        level = np.where(coded, 0, follow[depth][rows])
        kinds = (level > 0).sum(axis=1)
        mass = np.log2(np.maximum(level.sum(axis=1) + kinds, 1))
        with np.errstate(divide="ignore"):
            own_bits = mass[:, None] - np.log2(level)
            escape = mass - np.log2(kinds)
        bits = np.where(level > 0, spent[:, None] + own_bits, bits)
        spent = spent + np.where(kinds > 0, escape, 0)
        coded |= level > 0
        rows = parents[depth][rows]
    rest = np.log2(np.maximum(SYMBOLS - coded.sum(axis=1), 1))
    return np.where(coded, bits, (spent + rest)[:, None])


def _count_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = np.array(batch.column("lang").to_pylist(), object)
        raw, bounds = byte_buffers(batch.column("text"))
        owner = np.repeat(np.arange(len(names)), np.diff(bounds))
        for start in range(0, len(raw), WINDOW):
            stop = min(start + WINDOW, len(raw))
            codes = np.zeros(stop - start, np.int64)
            for back, part in enumerate(surroundings(raw, bounds, start, stop)):
                codes |= part.astype(np.int64) << (8 * back)
            spoken = names[owner[start:stop]]
            for lang in set(names[np.unique(owner[start:stop])]):
                found, times = np.unique(codes[spoken == lang], return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(found), pa.string()), "code": found, "n": times}
                )


def fit_trees(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    sample_documents: int = 1500,
) -> ContextTrees:
    """Trees of every language, from about ``sample_documents`` documents of each.

    Documents are chosen by a hash of their id, whole, outside the held-out
    fold; null languages, ids and texts teach nothing.
    """
    known = docs.select(
        F.col(id_column).alias("doc_id"), F.col(lang_column).alias("lang"), F.col(text_column).alias("text")
    ).where(~in_held_out_fold(F.col("doc_id")))
    known = known.dropna(subset=["lang", "doc_id"])
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return ContextTrees([], [])
    grain = 1_000_000
    share = F.create_map(
        *[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(grain, grain * sample_documents // n + 1))]
    )
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share[F.col("lang")])
    counted = (
        chosen.dropna(subset=["text"])
        .select("lang", F.col("text").cast("binary").alias("text"))
        .mapInArrow(_count_codes, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = np.array(counted.column("lang").to_pylist(), object)
    codes, times = counted.column("code").to_numpy(), counted.column("n").to_numpy()
    names = sorted(set(langs))
    counts = []
    for lang in names:
        own = langs == lang
        by_code = np.argsort(codes[own])
        counts.append((codes[own][by_code], times[own][by_code]))
    return ContextTrees(names, counts)


def identify(
    docs: DataFrame, trees: ContextTrees, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte), one row per document.

    ``score`` is the posterior of the predicted language at equal priors.  A
    text that is null, empty or without a letter is ``und`` with score 0 and
    null bits; so is every text if there are no trees.  Equal code lengths go
    to the language first in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            raw, bounds = byte_buffers(batch.column("text"))
            size = np.diff(bounds)
            known = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
            known &= bool(own.languages)
            if known.any():
                bits = own.bits(raw, bounds)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                posterior = 1 / np.exp2(np.minimum(0, least[:, None] - bits)).sum(axis=1)
                names = np.array(own.languages, object)[best]
            else:
                least = posterior = np.zeros(len(size))
                names = np.full(len(size), UNDETERMINED, object)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array(np.where(known, names, UNDETERMINED), pa.string()),
                    "score": np.where(known, posterior, 0.0),
                    "bits_per_byte": pa.array(least / np.maximum(size, 1), mask=~known),
                }
            )

    rows = keyed_text(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select(
        "doc_id",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
        F.col("text").cast("binary").alias("text"),
    ).mapInArrow(score, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")


def with_language(
    docs: DataFrame, trees: ContextTrees, text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """Rows whose text the best tree codes in fewer bits than its bytes take, ``lang`` predicted.

    Same columns and rows otherwise.  Texts are judged where they are read.  Rows
    with a null or empty text go; without any language to tell all rows stay as
    they are.
    """
    if not trees.languages:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    text_at, lang_at = docs.columns.index(text_column), docs.columns.index(lang_column)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = pa.array(own.languages, pa.string())
        for batch in batches:
            raw, bounds = byte_buffers(batch.column(text_at))
            bits = own.bits(raw, bounds)
            kept = pa.array(bits.min(axis=1) < UNIFORM_BITS * np.diff(bounds))
            columns = list(batch.columns)
            columns[lang_at] = names.take(pa.array(bits.argmin(axis=1)))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(kept)

    return docs.mapInArrow(judge, docs.schema)
