"""Terms by the bucket of their hash: no vocabulary is learnt, so none has to be kept or shipped."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scorestream.operators.naive_bayes import TermNaiveBayes, class_rows
from scorestream.operators.split import hash_bucket
from scorestream.operators.terms import term_counts
from scorestream.workspace import materialize


def hashed_tokens(tokens: Column, buckets: int) -> Column:
    """Each token's bucket as text, repeats kept; null tokens stay null."""
    return F.transform(tokens, lambda token: hash_bucket(token, buckets).cast("string"))


def bucket_load(df: DataFrame, tokens: Column, buckets: int, stop_words: Sequence[str] = ()) -> DataFrame:
    """Per bucket that occurs: ``cf`` occurrences, ``n_terms`` different terms, ``hidden`` occurrences.

    ``hidden`` are those of all but the most frequent term: what collisions cost.
    Terms are combined before anything moves; the second shuffle has a row per term.
    """
    counts = term_counts(df, tokens, stop_words)
    grouped = counts.groupBy(hash_bucket("term", buckets).alias("bucket"))
    loads = grouped.agg(F.sum("cf").alias("cf"), F.count("*").alias("n_terms"), F.max("cf").alias("_most"))
    return loads.select("bucket", "cf", "n_terms", (F.col("cf") - F.col("_most")).alias("hidden"))


def fit_hashed(
    train: DataFrame, label: str, tokens: Column, buckets: int, smoothing: float = 1.0
) -> TermNaiveBayes:
    """Multinomial naive Bayes over all ``buckets``, occurring or not.

    Score with ``predict`` on ``hashed_tokens`` of the same number of buckets.  The
    model is a table of ``buckets`` rows whatever the corpus.
    """
    known = train.where(F.col(label).isNotNull())
    rows = class_rows(known, label)
    classes = [row[label] for row in rows]
    n_rows = sum(row["n"] for row in rows)
    parts = {f"n_{i}": F.col(label) == F.lit(c) for i, c in enumerate(classes)}
    words = known.select(F.explode(hashed_tokens(tokens, buckets)).alias("term"), *(p.alias(n) for n, p in parts.items()))
    seen = words.groupBy("term").agg(*(F.count_if(name).cast("double").alias(name) for name in parts))
    every = train.sparkSession.range(buckets).select(F.col("id").cast("string").alias("term"))
    counts = every.join(seen, "term", "left").select(
        "term", F.lit(1.0).alias("idf"), *(F.coalesce(name, F.lit(0.0)).alias(name) for name in parts)
    )
    terms = materialize(counts, "hashed-model")
    totals = terms.agg(*(F.sum(name).alias(name) for name in parts)).first()
    return TermNaiveBayes(
        label=label,
        classes=classes,
        priors=[math.log(row["n"] + smoothing) - math.log(n_rows + smoothing * len(rows)) for row in rows],
        terms=terms,
        term_total=[totals[name] for name in parts],
        size=buckets,
        table_bytes=buckets * (len(str(buckets)) + 8 * (len(classes) + 4)),
        smoothing=smoothing,
        numeric_total=[{} for _ in rows],
    )
