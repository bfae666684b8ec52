"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, so that a question asked
anew with other values has the same template.  A capitalised word that opens a
sentence may be a name or not: windows are hashed in both readings of it.  To
spare the documents most of that, a window is first looked up once, with its
opening words left out; only where the benchmark has a window that agrees
elsewhere are its readings made.  Windows of eight template tokens of the
benchmark are joined by hash with those of the documents.  A join alone
also finds texts that merely share a form; so the values in the slots are
compared along each alignment: one value of the benchmark must stand for one
value of the document throughout, and two values for two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorestream.llm.frames import capped_cache, keyed_text, texts_of
from scorestream.workspace import materialize

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
BITS_PER_WINDOW = 64
MOST_FILTER_BITS = 1 << 30
MEMO = 400_000
#: Windows with more opening words than this are read in all ways without a look-up.
OPENERS_LEFT_OUT = 2
#: Characters of texts that are cut into windows together.
CHARS_AT_ONCE = 1 << 20

NUMBER_TOKEN = re.compile(r"(\d[\d.,]*)")
_LETTER = re.compile(r"[^\W\d_]")
#: Sentence marks to a full stop; every other ASCII byte that is no letter to a blank.
_FOLD = bytes(46 if c in b".!?\n" else c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
LONGEST_QUANTITY = 4
#: Fixed words for numbers; "one" is too often a pronoun.
NUMBER_WORDS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km mg g kg t s sec min h hr hrs hour hours minute minutes second seconds day days week weeks "
    "month months year years inch inches foot feet ft yard yards mile miles ounce ounces oz pound pounds lb "
    "lbs litre litres liter liters l ml gallon gallons percent degree degrees dollar dollars cent cents euro "
    "euros eur usd meter meters metre metres gram grams ton tons kilometers kilometres mph kph".split()
)
#: The low three bits of a token's code are its kind.
WORD, CAPITALISED, NUMBER, STOP, UNIT, NUMBER_WORD = range(6)
NUMBER_SLOT, NAME_SLOT, UNIT_SLOT = (np.uint64(8 * (k + 1)) for k in range(3))
MASK_TERMS = np.uint64(0xD6E8FEB86659FD93) * np.arange(1 << WINDOW, dtype=np.uint64)
FACTORS = np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, WINDOW + 1, dtype=np.uint64)


def token_code(token: bytes) -> int:
    """64-bit code of a token without case, its kind in the low three bits."""
    if token == b".":
        return STOP
    word = token.decode("utf-8", "surrogatepass")
    folded = word.lower()
    kind = WORD
    if word[0].isdigit():
        folded, kind = word.strip(".,").replace(",", ""), NUMBER
    elif folded in NUMBER_WORDS:
        kind = NUMBER_WORD
    elif folded in UNITS:
        kind = UNIT
    elif word[0].isupper() and word[1:].islower():
        kind = CAPITALISED
    return xxhash.xxh64_intdigest(folded.encode("utf-8", "surrogatepass")) & ~7 | kind


class Codes(dict):
    def __missing__(self, token: bytes) -> int:
        code = self[token] = token_code(token)
        return code


class _Separators(dict):
    """Whether a character beyond ASCII is no letter."""

    def __missing__(self, character: str) -> bool:
        found = self[character] = not (character.isascii() or _LETTER.match(character))
        return found


_separators = _Separators()


def token_list(text: str) -> list[bytes]:
    """Words, numbers and sentence marks (all as ``.``) of a text."""
    out: list[bytes] = []
    for place, part in enumerate(NUMBER_TOKEN.split(text)):
        if place % 2:
            out.append(part.encode())
        elif part:
            if not part.isascii():
                for character in filter(_separators.__getitem__, set(part)):
                    part = part.replace(character, " ")
            out += part.encode("utf-8", "surrogatepass").translate(_FOLD).replace(b".", b" . ").split()
    return out


def template(text: str, codes: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template codes, values, whether a slot) of the tokens of a text, opening words as they stand."""
    return tokens_of(text, codes)[:3]


def tokens_of(text: str, codes: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(template codes, values, whether a slot, whether perhaps a name) of the tokens of a text.

    Names are words with one capital at the front; at the start of a sentence or
    line such a word is perhaps one.  Units are unit words right after a number,
    which may be written in words.
    """
    return flat_tokens([text], codes)[:4]


def _quantities(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Number words in runs of at most ``LONGEST_QUANTITY``; a longer run is an enumeration and stays words."""
    at = np.flatnonzero(words)
    begins = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(owner[at]) != 0)][: len(at)])
    sizes = np.diff(np.r_[begins, len(at)])
    out = np.zeros(len(words), bool)
    out[at[np.repeat(sizes <= LONGEST_QUANTITY, sizes)]] = True
    return out


def flat_tokens(texts: list[str], codes: dict) -> tuple[np.ndarray, ...]:
    """As ``tokens_of`` for several texts one after the other, and which text each token is of."""
    lists = [token_list(text) for text in texts]
    sizes = np.array(list(map(len, lists)), np.int64)
    found = np.fromiter(map(codes.__getitem__, chain.from_iterable(lists)), np.uint64, sizes.sum())
    owner = np.repeat(np.arange(len(lists)), sizes)
    kind = found & np.uint64(7)
    opens = np.ones(len(found), bool)
    opens[1:] = (kind[:-1] == STOP) | (owner[1:] != owner[:-1])
    words = kind != STOP
    found, kind, opens, owner = found[words], kind[words], opens[words], owner[words]
    values = found & ~np.uint64(7)
    number = (kind == NUMBER) | _quantities(kind == NUMBER_WORD, owner)
    capital = kind == CAPITALISED
    name = capital & ~opens
    unit = kind == UNIT
    unit[:1] = False
    unit[1:] &= number[:-1] & (owner[1:] == owner[:-1])
    out = np.where(number, NUMBER_SLOT, np.where(name, NAME_SLOT, np.where(unit, UNIT_SLOT, values)))
    return out, values, number | name | unit, capital & opens, owner


def _mixed(sums: np.ndarray) -> np.ndarray:
    hashes = sums ^ sums >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _in_window(marks: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(marks)]
    return total[WINDOW:] - total[:-WINDOW]


def window_hashes(codes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of windows with at least ``LITERALS`` tokens that are no slots."""
    return next(readings(codes, slots, np.zeros(len(codes), bool)))[:2]


def readings(
    codes: np.ndarray, slots: np.ndarray, openers: np.ndarray, wanted: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, hashes, offsets of openers read as names) of windows, one choice of openers at a time.

    The first has no opener as a name.  In each reading at least ``LITERALS``
    tokens of a window are no slots.  ``wanted`` says which windows to read, all if
    left out.
    """
    count = len(codes) - WINDOW + 1
    if count <= 0:
        yield np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, 0), np.int64)
        return
    sums = np.zeros(count, np.uint64)
    for k in range(WINDOW):
        sums += codes[k : k + count] * FACTORS[k]
    filled = _in_window(slots)
    good = filled <= WINDOW - LITERALS
    good = np.flatnonzero(good if wanted is None else good & wanted)
    yield good, _mixed(sums[good]), np.zeros((len(good), 0), np.int64)
    unsure = _in_window(openers)[good]
    opener_at = np.flatnonzero(openers)
    for k in range(1, unsure.max(initial=0) + 1):
        at = good[unsure == k]
        if not len(at):
            continue
        places = opener_at[np.searchsorted(opener_at, at)[:, None] + np.arange(k)]
        offsets = places - at[:, None]
        change = (NAME_SLOT - codes[places]) * FACTORS[offsets]
        room = WINDOW - LITERALS - filled[at]
        for size in range(1, min(k, WINDOW - LITERALS) + 1):
            fits = np.flatnonzero(room >= size)
            for chosen in map(list, combinations(range(k), size)):
                named = sums[at[fits]] + change[fits][:, chosen].sum(axis=1, dtype=np.uint64)
                yield at[fits], _mixed(named), offsets[fits][:, chosen]


def left_out(codes: np.ndarray, masked: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Hashes of windows, one per row, without the tokens that are masked."""
    return _mixed((np.where(masked, np.uint64(0), codes) * FACTORS).sum(axis=1, dtype=np.uint64) + MASK_TERMS[masks])


def probes(codes: np.ndarray, openers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per window, its hash with the openers left out, and their number."""
    count = max(0, len(codes) - WINDOW + 1)
    plain = np.where(openers, np.uint64(0), codes)
    sums = np.zeros(count, np.uint64)
    masks = np.zeros(count, np.int64)
    for k in range(WINDOW):
        sums += plain[k : k + count] * FACTORS[k]
        masks |= openers[k : k + count].astype(np.int64) << k
    return _mixed(sums + MASK_TERMS[masks]), _in_window(openers) if count else masks


def _hit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = bits[hashes >> np.uint64(6) & np.uint64(len(bits) - 1)] >> (hashes & np.uint64(63))
    return (found & np.uint64(1)).astype(bool)


def _one_text(owner: np.ndarray) -> np.ndarray:
    """Whether all tokens of a window are of one text."""
    return owner[WINDOW - 1 :] == owner[: len(owner) - WINDOW + 1]


def _together(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) of a batch, a bounded number of characters at a time."""
    first, texts, size = 0, [], 0
    for text in texts_of(batch):
        texts.append(text)
        size += len(text)
        if size >= CHARS_AT_ONCE:
            yield first, texts
            first, texts, size = first + len(texts), [], 0
    if texts:
        yield first, texts


WINDOWS = "hash long, position int, slots array<struct<at:int,value:long,opener:boolean>>"
SLOTS = pa.list_(pa.struct([("at", pa.int32()), ("value", pa.int64()), ("opener", pa.bool_())]))


def _windows(docs: DataFrame, kept=None, partly=None) -> DataFrame:
    """(key, hash, position, slots) of the windows of each text.

    ``kept`` is a broadcast bit filter of window hashes, ``partly`` one of the
    hashes with words left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            keys = batch.column(0)
            rows: list[tuple] = []
            owners: list[int] = []
            for first, texts in _together(batch):
                capped_cache(codes, MEMO)
                out, values, slots, openers, owner = flat_tokens(texts, codes)
                starts = np.searchsorted(owner, np.arange(len(texts)))
                wanted = _one_text(owner)
                if partly is not None:
                    hashes, unsure = probes(out, openers)
                    wanted = wanted & (_hit(partly.value, hashes) | (unsure > OPENERS_LEFT_OUT))
                for at, hashes, named in readings(out, slots, openers, wanted):
                    if kept is not None and len(hashes):
                        hit = _hit(kept.value, hashes)
                        at, hashes, named = at[hit], hashes[hit], named[hit]
                    for place, code, own in zip(at.tolist(), hashes.view(np.int64).tolist(), named.tolist()):
                        slot = sorted(np.flatnonzero(slots[place : place + WINDOW]).tolist() + own)
                        held = values[place : place + WINDOW].view(np.int64).tolist()
                        text = owner[place]
                        rows.append((code, int(place - starts[text]), [{"at": a, "value": held[a], "opener": a in own} for a in slot]))
                        owners.append(first + int(text))
                    if len(rows) > 20_000:
                        yield _batch(keys, owners, rows)
                        rows, owners = [], []
            if rows:
                yield _batch(keys, owners, rows)

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(cut, f"key {kind}, {WINDOWS}")


def _partial_hashes(items: DataFrame) -> DataFrame:
    """(hash) of every reading of the items' windows without any choice of words that may be openers elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            for _, texts in _together(batch):
                capped_cache(codes, MEMO)
                out, _, slots, openers, owner = flat_tokens(texts, codes)
                for at, _, named in readings(out, slots, openers, _one_text(owner)):
                    read = out[at[:, None] + np.arange(WINDOW)] if len(at) else np.zeros((0, WINDOW), np.uint64)
                    np.put_along_axis(read, named, NAME_SLOT, axis=1)
                    fixed = (read == NUMBER_SLOT) | (read == UNIT_SLOT)
                    for size in range(OPENERS_LEFT_OUT + 1):
                        for chosen in map(list, combinations(range(WINDOW), size)):
                            open_rows = read[~fixed[:, chosen].any(axis=1)]
                            masked = np.isin(np.arange(WINDOW), chosen)
                            hashes = np.unique(left_out(open_rows, masked, sum(1 << k for k in chosen)))
                            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["hash"])

    return items.mapInArrow(run, "hash long").distinct()


def _batch(keys: pa.Array, owners: list[int], rows: list[tuple]) -> pa.RecordBatch:
    code, position, slots = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(owners)), pa.array(code, pa.int64()), pa.array(position, pa.int32()), pa.array(slots, SLOTS)],
        ["key", "hash", "position", "slots"],
    )


def _bit_filter(windows: DataFrame) -> np.ndarray:
    """64-bit words of a filter that has every window hash; a power of two of them, bounded in size."""
    wanted = max(1 << 16, BITS_PER_WINDOW * windows.count())
    words = min(1 << (wanted - 1).bit_length(), MOST_FILTER_BITS) >> 6
    place = F.shiftrightunsigned("hash", 6).bitwiseAND(F.lit(words - 1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("hash").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    set_bits = windows.select(place.alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    found = set_bits.toArrow()
    out = np.zeros(words, np.uint64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, coverage, slots, kind) of documents that hold an item.

    A document holds an item if alignments with consistent slots cover at least
    ``coverage`` of the item's distinct window positions; ``kind`` is
    ``verbatim`` if one alignment has every value as in the item, otherwise
    ``reparameterised``.  Items of fewer than eight template tokens, or without
    a window that has four plain words, are no more than a phrase and match
    nothing; null and empty texts on either side match nothing; null ids take
    no part; repeated rows count once.

    A slot is an opener if it opens a sentence on either side.  An opener with
    the same word on both sides is no slot.  Another word in its place must
    stand for it throughout; where it does not, it is no name, and only the
    windows that read it as one are dropped.
    """
    items = keyed_text(benchmark, item_column, item_text_column).dropna(subset=["doc_id"])
    own = materialize(_windows(items).withColumnRenamed("key", "item_id"), "benchmark-windows")
    context = docs.sparkSession.sparkContext
    kept = context.broadcast(_bit_filter(own))
    partly = context.broadcast(_bit_filter(materialize(_partial_hashes(items), "benchmark-partly")))
    theirs = _windows(keyed_text(docs, id_column, text_column).dropna(subset=["doc_id"]), kept, partly)
    sizes = own.groupBy("item_id").agg(F.countDistinct("position").alias("item_windows"))

    pairs = theirs.join(
        own.select("hash", "item_id", F.col("position").alias("item_position"), F.col("slots").alias("item_slots")), "hash"
    )
    both = F.zip_with(
        "item_slots",
        "slots",
        lambda i, d: F.struct(
            (F.col("item_position") + i["at"]).alias("at"),
            i["value"].alias("item"),
            d["value"].alias("doc"),
            (i["opener"] | d["opener"]).alias("opener"),
        ),
    )
    aligned = pairs.groupBy(
        F.col("key").alias("doc_id"), "item_id", (F.col("position") - F.col("item_position")).alias("shift")
    ).agg(F.collect_set(F.struct(F.col("item_position").alias("position"), both.alias("slots"))).alias("found"))
    pair = lambda s: F.struct(s["item"], s["doc"])
    aligned = aligned.withColumn("slots", F.array_distinct(F.flatten("found.slots")))
    aligned = aligned.withColumn("values", F.array_distinct(F.transform("slots", pair)))
    sure = F.array_distinct(F.transform(F.filter("slots", lambda s: ~s["opener"]), pair))
    consistent = (F.size(sure) == F.size(F.array_distinct(F.transform(sure, lambda s: s["item"])))) & (
        F.size(sure) == F.size(F.array_distinct(F.transform(sure, lambda s: s["doc"])))
    )
    renamed = F.array_distinct(
        F.transform(F.filter("slots", lambda s: s["opener"] & (s["item"] != s["doc"])), pair)
    )
    refused = F.filter(
        renamed,
        lambda s: F.exists("values", lambda v: (v["item"] == s["item"]) != (v["doc"] == s["doc"])),
    )
    aligned = aligned.where(consistent).withColumn("refused", refused)
    fits = lambda w: ~F.exists(w["slots"], lambda s: s["opener"] & F.array_contains("refused", pair(s)))
    aligned = aligned.withColumn("found", F.filter("found", fits)).where(F.size("found") > 0)
    slots = F.filter(
        F.array_distinct(F.flatten("found.slots")), lambda s: ~s["opener"] | (s["item"] != s["doc"])
    )
    aligned = aligned.select("doc_id", "item_id", F.col("found.position").alias("positions"), slots.alias("slots"))
    aligned = aligned.withColumn("same", ~F.exists("slots", lambda s: s["item"] != s["doc"]))
    held = aligned.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("positions")))).alias("windows"),
        F.max(F.size("slots")).alias("slots"),
        F.max("same").alias("same"),
    )
    share = F.col("windows") / F.col("item_windows")
    return (
        held.join(sizes, "item_id")
        .where(share >= coverage)
        .select(
            "doc_id",
            "item_id",
            "windows",
            "item_windows",
            share.alias("coverage"),
            "slots",
            F.when(F.col("same"), "verbatim").otherwise("reparameterised").alias("kind"),
        )
    )
