"""How far the sources of a language differ in their words, by a cube of cells.

A divergence adds up over all terms of a language for every ordered pair of its
sources.  The work is cut along three axes: sources into blocks, sources again,
and terms into blocks.  A cell (block, block, terms) owns the slices of its two
blocks of sources over its terms, adds up partial divergences of all pairs in
it, and the partial sums are reduced along the term axis.  A slice is sent to
one cell per block of partners, and no task holds more than two slices.

All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorestream.workspace import materialize

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
BEST_TERMS = 200
#: Sources per block and terms per block, on average: a cell holds about 2 * 48 * 20,000 numbers.
GROUP_BLOCK = 48
TERM_BLOCK = 20_000
#: Distinct (source, term) counts that a task holds before it passes them on.
HELD = 400_000
BLOCK_BYTES = 1 << 20

#: A-Z to lower case, every other ASCII byte that is no letter to a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def text_terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number of bytes at a time."""
    folded = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + BLOCK_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) combined in the task; a row without a term for every group met."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = [None, *n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *map(docs.__getitem__, n)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            key = lang.as_py() or "", source.as_py() or ""
            n, docs = groups.setdefault(key, (Counter(), Counter()))
            before = len(n)
            seen: set[bytes] = set()
            for terms in text_terms(text.as_py() or ""):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(n) - before + 1
            if held > HELD:
                yield from passed_on()
                held = 0
    yield from passed_on()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; one row with a null term per group."""
    rows = docs.select(*(F.col(c).cast("string").alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    counted = rows.mapInArrow(_counts, "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact beyond 64 bits."""
    return 1 + F.call_function(
        "div",
        F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)"),
        (total + terms).cast("decimal(19,0)"),
    )


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _partial(table: pa.Table) -> pa.Table:
    """Divergences of all ordered pairs of one cell, each pair with a source of either block.

    A row without a term gives a source its share of terms that it lacks and
    the number of terms in the block; other rows give a share of one term.
    """
    first, second, lang = (table.column(c)[0].as_py() for c in ("first", "second", "lang"))
    own = table.filter(pc.is_null(table.column("term")))
    named = table.filter(pc.is_valid(table.column("term")))
    sources, blocks, lacking = own.column("source").to_pylist(), own.column("block").to_numpy(), own.column("share").to_numpy()
    place = pc.index_in(named.column("source"), pa.array(sources, pa.string())).to_numpy()
    terms = pa.chunked_array(named.column("term").chunks, pa.string()).combine_chunks().dictionary_encode()
    shares = np.repeat(lacking[:, None], len(terms.dictionary), axis=1)
    shares[place, terms.indices.to_numpy()] = named.column("share").to_numpy()
    unseen = own.column("terms")[0].as_py() - shares.shape[1]
    out: list[tuple[str, str, int]] = []
    for i, item in enumerate(sources):
        others = np.flatnonzero((blocks != blocks[i]) if first != second else np.arange(len(sources)) != i)
        values = ((lacking[others] - lacking[i]) ** 2 // lacking[i]) * unseen
        for at, other in enumerate(others):
            apart = shares[other] - shares[i]
            values[at] += (apart * apart // shares[i]).sum()
        out += [(sources[o], item, v) for o, v in zip(others, values.tolist())]
    source, item, value = zip(*out) if out else ((), (), ())
    return pa.table(
        [pa.array([lang] * len(out), pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())],
        ["lang", "source", "item", "value"],
    )


def pair_divergences(
    shares: DataFrame, groups: DataFrame, sizes: DataFrame, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK
) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language.

    ``shares`` has (lang, source, term, share) where a source has the term,
    ``groups`` (lang, source, lacking), ``sizes`` (lang, term) of all kept terms.
    """
    axes = groups.groupBy("lang").agg(F.count("*").alias("n_groups")).join(
        sizes.groupBy("lang").agg(F.count("*").alias("n_terms")), "lang", "left"
    )
    along = lambda n, size: F.ceil(F.coalesce(n, F.lit(0)) / size).cast("int")
    axes = axes.select(
        "lang",
        along(F.col("n_groups"), group_block).alias("group_blocks"),
        F.greatest(along(F.col("n_terms"), term_block), F.lit(1)).alias("term_blocks"),
    )
    axes = materialize(axes, "cube-axes")
    block = F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int").alias("block")
    slab = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("slab")
    held = sizes.join(axes, "lang").groupBy("lang", slab).agg(F.count("*").alias("terms"))
    every = F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("slab")
    own = groups.join(axes, "lang").select("lang", "source", block, "group_blocks", every, F.col("lacking").alias("share"))
    own = own.join(held, ["lang", "slab"], "left").select(
        "lang", "source", "block", "group_blocks", "slab", F.lit(None).cast("string").alias("term"), "share",
        F.coalesce("terms", F.lit(0)).alias("terms"),
    )
    named = shares.join(axes, "lang").select(
        "lang", "source", block, "group_blocks", slab, "term", "share", F.lit(None).cast("long").alias("terms")
    )
    slices = own.unionByName(named).withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
    cells = slices.select(
        "lang", "slab", F.least("block", "partner").alias("first"), F.greatest("block", "partner").alias("second"),
        "source", "block", "term", "share", "terms",
    )
    partial = cells.groupBy("lang", "slab", "first", "second").applyInArrow(
        _partial, "lang string, source string, item string, value long"
    )
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence_audit(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    best_terms: int = BEST_TERMS,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): sources against each other and against their language.

    A language keeps the terms that ``least_documents`` of its documents have.  The
    share of a term is 1 + floor(10^9 * (n + 1) / (N + V)) with its occurrences n,
    those of all kept terms N, and their number V; the divergence of share p from
    share q is floor((p - q)^2 / q).  Part ``pair`` adds it up over all kept terms
    for every other source of the language, part ``term`` gives the ``best_terms``
    terms that a source has more of than its language.

    Null text, language and source are read as ''; a source without terms has its
    pairs, and no terms; a language of one source has no pairs; without kept terms
    every pair has 0.  Repeated rows are documents of their own; further columns
    are not read.
    """
    counts = materialize(term_counts(docs, text_column, lang_column, source_column), "term-counts")
    named = counts.where(F.col("term").isNotNull())
    kept = named.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = materialize(kept.where(F.col("docs") >= least_documents).drop("docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("total").alias("lang_n"))
    held = materialize(named.drop("docs").join(kept, ["lang", "term"]), "source-terms")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    some = zero("n_terms") > 0
    lacking = F.when(some, _share(F.lit(0), zero("source_n"), zero("n_terms"))).otherwise(F.lit(1))
    groups = materialize(groups.select("lang", "source", "source_n", "lang_n", "n_terms", lacking.alias("lacking")), "sources")

    shares = held.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        _share(F.col("n"), F.col("source_n"), F.col("n_terms")).alias("share"),
        _share(F.col("total"), F.col("lang_n"), F.col("n_terms")).alias("lang_share"),
    )
    pairs = pair_divergences(shares, groups, kept, group_block, term_block)
    terms = shares.where(F.col("share") > F.col("lang_share")).select(
        "lang", "source", F.col("term").alias("item"), _distance(F.col("share"), F.col("lang_share")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).withColumn("rank", rank).select(columns)
        .unionAll(
            terms.withColumn("part", F.lit("term")).withColumn("rank", rank).where(F.col("rank") <= best_terms).select(columns)
        )
    )
