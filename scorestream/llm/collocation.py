"""Phrase collocations from sorted count streams.

A phrase is written as its words, each ended by a blank, with the language as
word zero: ``en of the ``.  In byte order all phrases that begin alike lie
together and a phrase lies right before its continuations.  Counts are never
looked up; they are taken from streams in that order:

* Windows of up to four words, one per word of the text, are combined inside the
  tasks, written, and dealt out by range.  One pass over a sorted range adds up
  the runs of every prefix, so one stream gives the counts of phrases of every
  length and of the language itself.
* Phrases that reach the least count are kept in prefix order, and in suffix
  order by their words from the last to the first.  The set holds every part of
  its phrases, so the running last count of each length is the count of a
  phrase's left part in one order and of its right part in the other; the
  running last phrase that is one word shorter is the one it extends.  Parts and
  extensions of both orders then meet in merge joins by phrase.

Two words that stand side by side less often than the least count are in no
candidate, so windows stop between them.  Such pairs are told by a bit filter of
bounded size over hashed pairs; a false alarm makes a window longer, not wrong.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorestream.workspace import materialize

LONGEST = 4
LEAST = 30
COVER_PERCENT = 80
SCALE = 2_000_000
BEST = 2000
#: Distinct windows, or a tenth of the pairs, that a task holds before it passes their counts on.
HELD = 400_000
#: Bytes of a text that are cut into words at once.
BLOCK_BYTES = 1 << 20
BITS_PER_HASH = 64
MOST_FILTER_BITS = 1 << 30

#: A-Z to lower case; every mark between pieces to a full stop, which no word can hold.
_MARKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _MARKS, bytes(range(97, 123)) + b"." * len(_MARKS))
_BETWEEN = re.compile(rb"[ \t.]")
_FIRST, _SECOND, _SPREAD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def word_blocks(text: str | None) -> Iterator[tuple[list[bytes], int]]:
    """(words, own) of a text block by block; ``.`` stands between pieces.

    Windows that begin at the first ``own`` words belong to the block; the words
    after them are repeated at the head of the next one.
    """
    folded = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    carried: list[bytes] = []
    at = 0
    while at < len(folded):
        cut = _BETWEEN.search(folded, min(at + BLOCK_BYTES, len(folded)))
        end = cut.end() if cut else len(folded)
        words = carried + folded[at:end].replace(b".", b" . ").split()
        own = len(words) if end == len(folded) else max(0, len(words) - LONGEST + 1)
        yield words, own
        carried, at = words[own:], end


def language_word(lang: str | None) -> bytes:
    """The language as a word without a blank; null is ``und``."""
    return ("und" if lang is None else lang).replace("%", "%25").replace(" ", "%20").encode("utf-8", "surrogatepass")


def _language(word: Column) -> Column:
    return F.replace(F.replace(word, F.lit("%20"), F.lit(" ")), F.lit("%25"), F.lit("%"))


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        code = self[word] = 0 if word == b"." else xxhash.xxh64_intdigest(word) | 1
        return code


def _pairs(lang: bytes, words: list[bytes], codes: _Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each is a word, hash of it with the next, and whether both are words of one piece."""
    if len(codes) > HELD:
        codes.clear()
    found = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    mixed = found[:-1] * _FIRST + found[1:] * _SECOND + np.uint64(xxhash.xxh64_intdigest(lang))
    mixed ^= mixed >> np.uint64(31)
    mixed *= _SPREAD
    mixed ^= mixed >> np.uint64(29)
    is_word = found != 0
    return is_word, mixed, is_word[:-1] & is_word[1:]


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = _Codes()
    gathered: list[np.ndarray] = []

    def combined() -> pa.RecordBatch:
        hashes, n = np.unique(np.concatenate(gathered or [np.zeros(0, np.uint64)]), return_counts=True)
        gathered.clear()
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            own_language = language_word(lang.as_py())
            for words, own in word_blocks(text.as_py()):
                _, pairs, whole = _pairs(own_language, words, codes)
                gathered.append(pairs[:own][whole[:own]])
                held += own
                if held > 10 * HELD:
                    yield combined()
                    held = 0
    yield combined()


def _bit_filter(hashes: DataFrame) -> np.ndarray:
    """64-bit words of a filter that has every hash; a power of two of them, bounded in size."""
    wanted = max(1 << 16, BITS_PER_HASH * hashes.count())
    words = min(1 << (wanted - 1).bit_length(), MOST_FILTER_BITS) >> 6
    place = F.shiftrightunsigned("hash", 6).bitwiseAND(F.lit(words - 1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("hash").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    set_bits = hashes.select(place.alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    found = set_bits.toArrow()
    out = np.zeros(words, np.uint64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _windows(words: list[bytes], at: np.ndarray, joins: np.ndarray) -> list[bytes]:
    """The window at each of the given words; it stops where ``joins`` says no."""
    if not len(at):
        return []
    padded = np.r_[joins, np.zeros(LONGEST, bool)]
    reach = np.ones(len(at), np.int64)
    alive = np.ones(len(at), bool)
    for k in range(LONGEST - 1):
        alive &= padded[at + k]
        reach += alive
    joined = b" ".join(words) + b" "
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-1]][at].tolist()
    return [joined[s:e] for s, e in zip(starts, ends[at + reach - 1].tolist())]


def _window_counts(docs: DataFrame, kept) -> DataFrame:
    """(phrase, n) of windows, combined in the task; windows of one word are counted by the word itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = kept.value
        codes = _Codes()
        counts: dict[bytes, tuple[Counter, Counter]] = {}
        held = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, (single, longer) in counts.items():
                head = lang + b" "
                phrases = [*(head + w + b" " for w in single), *(head + w for w in longer)]
                n = [*single.values(), *longer.values()]
                yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), pa.array(n, pa.int64())], ["phrase", "n"])
            counts.clear()

        def frequent(hashes: np.ndarray) -> np.ndarray:
            hit = bits[hashes >> np.uint64(6) & np.uint64(len(bits) - 1)] >> (hashes & np.uint64(63))
            return (hit & np.uint64(1)).astype(bool)

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                own_language = language_word(lang.as_py())
                for words, own in word_blocks(text.as_py()):
                    is_word, pairs, whole = _pairs(own_language, words, codes)
                    joins = frequent(pairs) & whole
                    long = np.r_[joins, False][: len(words)][:own]
                    single, longer = counts.setdefault(own_language, (Counter(), Counter()))
                    before = len(single) + len(longer)
                    single.update(compress(words, (is_word[:own] & ~long).tolist()))
                    longer.update(_windows(words, np.flatnonzero(long), joins))
                    held += len(single) + len(longer) - before
                    if held > HELD:
                        yield from passed_on()
                        held = 0
        yield from passed_on()

    return docs.mapInArrow(run, "phrase binary, n long")


class _Runs:
    """Adds up the runs of one prefix length over a sorted range.

    The first and the last run of the range may go on in its neighbours, so
    they are passed on whatever their sum; others from ``least`` on.
    """

    def __init__(self, least: int):
        self.least = least
        self.phrase: bytes | None = None
        self.total = 0
        self.first = True
        self.found: list[tuple[bytes, int]] = []

    def close(self, last: bool = False) -> None:
        if self.phrase is not None:
            if self.first or last or self.total >= self.least:
                self.found.append((self.phrase, self.total))
            self.first = False
        self.phrase = None

    def add(self, starts: np.ndarray, sums: np.ndarray, prefix_at) -> None:
        """Runs of the next batch; the first of them may continue the open one."""
        if len(starts) and prefix_at(starts[0]) == self.phrase:
            self.total += int(sums[0])
            starts, sums = starts[1:], sums[1:]
        if not len(starts):
            return
        self.close()
        wanted = sums[:-1] >= self.least
        if self.first and len(wanted):
            wanted[0], self.first = True, False
        self.found += [(prefix_at(starts[i]), int(sums[i])) for i in np.flatnonzero(wanted)]
        self.phrase, self.total = prefix_at(starts[-1]), int(sums[-1])


def _prefix_sums(least: int):
    """(phrase, size, n) of the prefixes of a sorted range, whole or in part at its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [_Runs(least) for _ in range(LONGEST + 1)]

        def passed_on() -> Iterator[pa.RecordBatch]:
            for size, own in enumerate(runs):
                phrases, sums = zip(*own.found) if own.found else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(phrases, pa.binary()), pa.array([size] * len(sums), pa.int32()), pa.array(sums, pa.int64())],
                    ["phrase", "size", "n"],
                )
                own.found = []

        for batch in batches:
            if not batch.num_rows:
                continue
            phrases, n = batch.column("phrase"), batch.column("n").to_numpy()
            parts = pc.split_pattern(phrases, " ")
            word = parts.flatten().dictionary_encode().indices.to_numpy()
            bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
            words = np.full((batch.num_rows, LONGEST + 1), -1, np.int64)
            for size in range(LONGEST + 1):
                has = np.flatnonzero(np.diff(bounds) - 1 > size)
                words[has, size] = word[bounds[has] + size]
            new = np.ones(words.shape, bool)
            new[1:] = np.logical_or.accumulate(words[1:] != words[:-1], axis=1)
            for size, own in enumerate(runs):
                has = words[:, size] >= 0
                starts = np.flatnonzero(new[:, size] & has)
                sums = np.add.reduceat(np.where(has, n, 0), starts) if len(starts) else n[:0]
                own.add(
                    starts, sums, lambda i: b" ".join(phrases[int(i)].as_py().split(b" ", size + 1)[: size + 1]) + b" "
                )
            yield from passed_on()
        for own in runs:
            own.close(last=True)
        yield from passed_on()

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(phrase, size, n) of all phrases of up to four words that occur ``least`` times in a language.

    ``phrase`` has the language as word zero; the phrase of size 0 is the language
    with its number of words.  Every part of a phrase is there as well.
    """
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    pairs = rows.mapInArrow(_pair_counts, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    often = materialize(pairs.where(F.col("n") >= least).select("hash"), "frequent-pairs")
    kept = docs.sparkSession.sparkContext.broadcast(_bit_filter(often))
    windows = materialize(_window_counts(rows, kept), "window-counts")
    sums = (
        windows.repartitionByRange("phrase")
        .sortWithinPartitions("phrase")
        .mapInArrow(_prefix_sums(least), "phrase binary, size int, n long")
    )
    whole = sums.groupBy("phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return materialize(whole.withColumn("phrase", F.col("phrase").cast("string")), "phrase-counts")


def _words(phrase: Column, size: Column) -> Column:
    """The words of a phrase without its language."""
    return F.slice(F.split(phrase, " "), F.lit(2), size)


def _in_step(phrases: DataFrame, key: Column) -> DataFrame:
    """Each phrase with ``parts``, the last (n, phrase) of each size at or before it in the order of ``key``.

    Sorted ranges are read one by one; what the ranges before it saw last, one
    row per range, is carried into each.
    """
    ranged = phrases.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key")
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id()), "phrase-stream")
    sizes = range(LONGEST)
    seen = [F.when(F.col("size") == k, F.struct("n", "phrase")) for k in sizes]
    last = [F.max_by(F.struct("n", "phrase"), F.when(F.col("size") == k, F.col("key"))).alias(f"_{k}") for k in sizes]
    ends = ranged.groupBy("range").agg(F.min("key").alias("first"), *last)
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("range", *(F.last(f"_{k}", ignorenulls=True).over(before).alias(f"_{k}") for k in sizes))
    so_far = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    parts = F.array(*(F.coalesce(F.last(seen[k], ignorenulls=True).over(so_far), f"_{k}") for k in sizes))
    return ranged.join(carried, "range").select("phrase", "size", "n", parts.alias("parts"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    best: int = BEST,
    cover_percent: int = COVER_PERCENT,
    scale: int = SCALE,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``best`` phrases of each language.

    Candidates are phrases of 2 to 4 words inside one piece that occur ``least``
    times in a language.  A phrase scores by its weakest cut into two parts,
    floor(scale * a / (l + r)), the earliest of equals; one that lies in a longer
    candidate with at least ``cover_percent`` of its count is dropped.  (A longer
    candidate of two more words holds one of one more with no smaller count, so
    extensions by one word decide.)  Ties of score and count are ordered by the
    bytes of the phrase.

    Null and empty texts have no words, a null language is ``und``; repeated rows
    count as often as they occur; further columns are not read.
    """
    phrases = phrase_counts(docs, least, text_column, lang_column)
    words = _words(F.col("phrase"), F.col("size"))
    lang_word = F.split_part(F.col("phrase"), F.lit(" "), F.lit(1))
    forward = materialize(_in_step(phrases, F.col("phrase")), "prefix-order")
    backward = materialize(
        _in_step(phrases, F.concat(F.concat_ws(" ", lang_word, F.reverse(words)), F.lit(" "))), "suffix-order"
    )
    longer = F.col("size") > 2
    shorter = F.col("parts")[F.col("size") - 1]["phrase"].alias("phrase")
    extended = (
        forward.where(longer)
        .select(shorter, "n")
        .unionAll(backward.where(longer).select(shorter, "n"))
        .groupBy("phrase")
        .agg(F.max("n").alias("extension"))
    )
    counted = F.transform(F.col("parts"), lambda p: p["n"])
    candidates = (
        forward.where(F.col("size") > 1)
        .select("phrase", "size", F.col("n").alias("a"), counted.alias("left"))
        .join(backward.where(F.col("size") > 1).select("phrase", counted.alias("right")).hint("merge"), "phrase")
        .join(extended.hint("merge"), "phrase", "left")
    )
    percent = lambda c, p: F.col(c).cast("decimal(19,0)") * F.lit(p).cast("decimal(10,0)")
    covered = percent("extension", 100) >= percent("a", cover_percent)
    candidates = candidates.where(~F.coalesce(covered, F.lit(False)))
    cut = lambda k: F.struct(
        F.call_function(
            "div",
            F.lit(scale).cast("decimal(10,0)") * F.col("a").cast("decimal(19,0)"),
            (F.col("left")[k] + F.col("right")[F.col("size") - k]).cast("decimal(19,0)"),
        ).alias("score"),
        k.alias("k"),
    )
    weakest = F.array_min(F.transform(F.sequence(F.lit(1), F.col("size") - 1), cut))
    scored = candidates.withColumn("cut", weakest).select(
        _language(lang_word).alias("lang"),
        F.array_join(words, " ").alias("phrase"),
        "a",
        F.col("left")[F.col("cut.k")].alias("l"),
        F.col("right")[F.col("size") - F.col("cut.k")].alias("r"),
        F.col("left")[0].alias("n"),
        F.col("cut.score").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= best)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
