"""SimHash fingerprints, linked through anchor points of a covering code.

Two fingerprints that differ in at most three of 64 bits differ in at most one
bit of one 32-bit half.  Over the low 31 bits of a half the Hamming code of
length 31 is perfect: its code words are the anchors, every value lies within
covering radius 1 of exactly one.  A fingerprint is replicated to every anchor
within covering radius plus threshold, 1 + 1 = 2, which are at most 16; its
partner's own anchor is among them.  Per anchor, fingerprints at home there are
compared with all that visit it, on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorestream.llm.components import smallest_reachable
from scorestream.llm.frames import keyed_text
from scorestream.workspace import materialize

SEED = 42
SHINGLE = 3
LINK_BITS = 3
HALF_BITS = 31
COUNTED_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ends = (starts[shingle:] - 1).tolist()
    starts = starts[: len(ends)].tolist()
    digest = xxhash.xxh64_digest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(ends), COUNTED_AT_ONCE):
        spans = zip(starts[at : at + COUNTED_AT_ONCE], ends[at : at + COUNTED_AT_ONCE])
        hashes = np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in spans]), np.uint8)
        votes += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(ends)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter(
            (fingerprint(value.as_py() or b"") for value in batch.column("text")), np.uint64, batch.num_rows
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "code"]
        )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, code): the fingerprint's 64 bits as a signed number."""
    rows = keyed_text(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, f"doc_id {kind}, code long")


def _syndrome(value: Column) -> Column:
    """Position, from 1, of the bit whose flip makes ``value`` a code word; 0 if it is one."""
    total = F.lit(0)
    for k in range(HALF_BITS.bit_length()):
        mask = sum(1 << (i - 1) for i in range(1, HALF_BITS + 1) if i >> k & 1)
        parity = F.bit_count(value.bitwiseAND(F.lit(mask).cast("long"))) % 2
        total = total + parity * (1 << k)
    return total


def _flip(value: Column, position: Column) -> Column:
    """``value`` with the bit at ``position``, counted from 1, turned over."""
    return value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), position - 1))


def _anchors(value: Column, syndrome: Column) -> Column:
    """Code words within distance 2 of ``value``, its nearest first."""
    nearest = F.when(syndrome == 0, value).otherwise(_flip(value, syndrome))
    pairs = F.transform(
        F.filter(
            F.sequence(F.lit(1), F.lit(HALF_BITS)),
            lambda i: (syndrome != 0) & (i.bitwiseXOR(syndrome) > i),
        ),
        lambda i: _flip(_flip(value, i), i.bitwiseXOR(syndrome)),
    )
    return F.concat(F.array(nearest), pairs)


def replicas(codes: DataFrame) -> DataFrame:
    """(node, code, half, anchor, home) of each code at every anchor of both halves."""
    values = codes.select(
        "node",
        "code",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(half).alias("half"),
                        F.shiftrightunsigned("code", 32 * half)
                        .bitwiseAND(F.lit((1 << HALF_BITS) - 1).cast("long"))
                        .alias("value"),
                    )
                    for half in (0, 1)
                ]
            )
        ).alias("part"),
    ).select("node", "code", "part.*")
    values = values.withColumn("syndrome", _syndrome(F.col("value")))
    return values.select(
        "node",
        "code",
        "half",
        F.posexplode(_anchors(F.col("value"), F.col("syndrome"))).alias("place", "anchor"),
    ).select("node", "code", "half", "anchor", (F.col("place") == 0).alias("home"))


def links(codes: DataFrame, most: int = LINK_BITS) -> DataFrame:
    """(a, b) of nodes with different codes at ``most`` or fewer differing bits, each once or more.

    Every code must stand for one node; at most ``LINK_BITS`` bits can be asked for.
    The engine sizes a table of replicas by its nodes, some 32 times too low, so
    it may not choose to broadcast one: both sides are always shuffled.
    """
    if most > LINK_BITS:
        raise ValueError(f"the anchors guarantee links of up to {LINK_BITS} bits")
    spread = replicas(codes)
    at_home = spread.where("home").select("half", "anchor", F.col("node").alias("a"), F.col("code").alias("own"))
    visiting = spread.select("half", "anchor", F.col("node").alias("b"), "code")
    near = F.bit_count(F.col("own").bitwiseXOR(F.col("code"))) <= most
    return at_home.join(visiting.hint("merge"), ["half", "anchor"]).where(near & (F.col("a") != F.col("b"))).select("a", "b")


def _components(marked: DataFrame) -> DataFrame:
    """(code, component_id) of written (doc_id, code) rows: the smallest id reachable over links."""
    nodes = materialize(marked.groupBy("code").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    known = nodes.dropna(subset=["node"])
    lowest = smallest_reachable(links(known), "simhash-links").select("node", "component")
    return nodes.join(lowest, "node", "left").select("code", F.coalesce("component", "node").alias("component_id"))


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document.

    Null, empty and blank texts have fingerprint zero and link like any other;
    the component is the smallest id reachable over links of up to three bits.
    Equal fingerprints are one node before anything is replicated.  Rows with a
    null id count for no component's id, but have one if their fingerprint does.
    """
    marked = materialize(fingerprints(docs, id_column, text_column), "simhash")
    return marked.join(_components(marked), "code").select(
        "doc_id",
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of near copies, whole and with all columns; the others go.

    Every row is judged by the fingerprint of its own text: of the rows of a group
    that bear the id naming it, the one with the smallest hash of all its columns
    stays.  So rows that share an id but not their texts' group each count for
    their own, and no order of the rows, nor a second run, changes what stays.
    Rows with a null id belong to no group and stay.
    """
    row = "_row" + "_" * max(map(len, docs.columns))
    rows = docs.withColumn(row, F.xxhash64(*docs.columns))
    known = rows.dropna(subset=[id_column]).select(F.struct(F.col(id_column).alias("doc_id"), F.col(row).alias("row")).alias("doc_id"), F.col(text_column).alias("text"))
    marked = materialize(fingerprints(known).select("doc_id.*", "code"), "simhash-rows")
    groups = marked.join(_components(marked), "code")
    kept = groups.groupBy("component_id").agg(
        F.min(F.when(F.col("doc_id") == F.col("component_id"), F.col("row"))).alias("row")
    )
    kept = kept.select(F.col("component_id").alias("doc_id"), "row")
    same = (rows[id_column] == kept["doc_id"]) & (rows[row] == kept["row"])
    once = rows.join(kept, same, "left_semi").dropDuplicates([id_column, row]).drop(row)
    return once.unionByName(docs.where(F.col(id_column).isNull()))
