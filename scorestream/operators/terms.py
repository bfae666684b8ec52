"""Term statistics as grouped aggregates over exploded tokens.

Every aggregate below is keyed by term and combined on the map side first, so
what is shuffled is bounded by the distinct terms of each task, however often
the most frequent word occurs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scorestream.operators.lookup import BROADCAST_BYTES, lookup_join, measured_bytes


def english_stop_words() -> list[str]:
    """The default stop list of ``StopWordsRemover``."""
    return StopWordsRemover.loadDefaultStopWords("english")


def explode_terms(
    df: DataFrame, tokens: Column, keep: Sequence[str] = (), stop_words: Sequence[str] = ()
) -> DataFrame:
    """One row per token, stop words dropped."""
    rows = df.select(*keep, F.explode(tokens).alias("term"))
    return rows.where(~F.col("term").isin(list(stop_words))) if stop_words else rows


def term_counts(
    df: DataFrame,
    tokens: Column,
    stop_words: Sequence[str] = (),
    parts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per term: occurrences ``cf``, documents ``df``, and occurrences per part.

    ``parts`` names conditions on the document.  Tokens and distinct tokens of
    a document are exploded side by side, so that one scan and one shuffle of
    partial counts give both numbers; no (document, term) pair is shuffled.
    """
    parts = parts or {}
    flags = {f"_part_{i}": condition for i, condition in enumerate(parts.values())}
    words = df.select(
        *(condition.alias(flag) for flag, condition in flags.items()), tokens.alias("_words")
    )
    both = F.array(
        F.struct(F.col("_words").alias("words"), F.lit(True).alias("every")),
        F.struct(F.array_distinct("_words").alias("words"), F.lit(False).alias("every")),
    )
    rows = words.select(*flags, F.inline(both)).select(
        *flags, "every", F.explode("words").alias("term")
    )
    if stop_words:
        rows = rows.where(~F.col("term").isin(list(stop_words)))
    return rows.groupBy("term").agg(
        F.count_if("every").alias("cf"),
        F.count_if(~F.col("every")).alias("df"),
        *(
            F.count_if(F.col("every") & F.col(flag)).alias(name)
            for name, flag in zip(parts, flags)
        ),
    )


def vocabulary(counts: DataFrame, vocab_size: int = 10000, min_df: int = 5) -> DataFrame:
    """The most frequent terms that occur in enough documents.

    Ties at the cut go to the alphabetically first term.  The cut is found on
    the number of terms per frequency, a small table; terms above it are kept
    where they are, and only those that tie with it are ordered.  ``counts`` is
    read three times, so pass a written table.
    """
    frequent = counts.where(F.col("df") >= min_df)
    falling = Window.orderBy(F.desc("cf")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = frequent.groupBy("cf").agg(F.count("*").alias("n")).withColumn("so_far", F.sum("n").over(falling))
    reached = steps.where(F.col("so_far") >= vocab_size).orderBy(F.desc("cf")).first()
    if reached is None:
        return frequent
    above = frequent.where(F.col("cf") > reached["cf"])
    tied = frequent.where(F.col("cf") == reached["cf"]).orderBy("term")
    return above.unionByName(tied.limit(vocab_size - (reached["so_far"] - reached["n"])))


def inverse_document_frequency(n_documents: Column, df: str = "df") -> Column:
    """``ln((N + 1) / (df + 1))``."""
    return F.log((n_documents + F.lit(1.0)) / (F.col(df) + F.lit(1.0)))


def with_idf(terms: DataFrame, documents: DataFrame) -> DataFrame:
    """Add the inverse document frequency; N comes from a scalar subquery."""
    n_documents = documents.agg(F.count("*").alias("n")).scalar()
    return terms.withColumn("idf", inverse_document_frequency(n_documents))


def counted_terms(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """One row per document and distinct term, with its count ``tf``; counted inside the row.

    Sorted tokens fall into runs; the length of a run is where the next begins
    less where it begins.  No lambda captures a column, because what it captures
    is evaluated for every element.
    """
    rows = df.select(key, F.array_sort(tokens).alias("_ordered")).where(F.size("_ordered") > 0)
    ordered = F.col("_ordered")
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(ordered, 1, F.size(ordered) - 1))
    marked = F.zip_with(ordered, before, lambda t, b: F.struct(t.alias("term"), (~t.eqNullSafe(b)).alias("first")))
    placed = F.transform(marked, lambda x, i: F.struct(x["term"].alias("term"), i.alias("at"), x["first"].alias("first")))
    rows = rows.select(key, F.filter(placed, lambda x: x["first"]).alias("_runs"), F.size(ordered).alias("_n"))
    runs = F.col("_runs")
    end = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.col("_n").alias("at"), F.lit(True).alias("first")))
    following = F.concat(F.slice(runs, 2, F.size(runs)), end)
    counted = F.zip_with(
        runs, following, lambda x, y: F.struct(x["term"].alias("term"), (y["at"] - x["at"]).cast("bigint").alias("tf"))
    )
    found = rows.select(key, F.inline_outer(counted))
    return found.where(F.col("term").isNotNull())


#: A vocabulary of at most this many terms is counted by the library's model: its own default size.
MODEL_TERMS = 1 << 18


def vocabulary_counts(df: DataFrame, key: str, tokens: Column, table: DataFrame) -> DataFrame:
    """Per document and term of ``table``: its count ``tf`` and the table's other columns.

    The library's count model hashes the tokens of a row in compiled code; what it
    makes is a sparse vector whose places name the rows of ``table``, broadcast
    here.  For tables of at most ``MODEL_TERMS`` different terms, at least one.
    """
    listed = table.collect()
    places = table.sparkSession.createDataFrame(
        [(i, *row) for i, row in enumerate(listed)],
        T.StructType([T.StructField("_place", T.IntegerType()), *table.schema.fields]),
    )
    model = CountVectorizerModel.from_vocabulary([row["term"] for row in listed], "_tokens", "_counts")
    rows = model.transform(df.select(key, F.coalesce(tokens, F.array().cast("array<string>")).alias("_tokens")))
    vector = F.unwrap_udt("_counts")
    pairs = rows.select(key, F.arrays_zip(vector["indices"].alias("_place"), vector["values"].alias("tf")).alias("_pairs"))
    # Not ``inline``: its inferred filter on the length of the pairs would count every row once more, below the scan.
    counts = pairs.select(key, F.inline_outer("_pairs")).withColumn("tf", F.col("tf").cast("bigint"))
    return counts.join(F.broadcast(places), "_place").drop("_place")


def term_weights(
    df: DataFrame, key: str, tokens: Column, idf: DataFrame, stop_words: Sequence[str] = ()
) -> DataFrame:
    """Per document and vocabulary term: count, idf and their product.

    Terms are counted inside the row, so nothing is shuffled as long as ``idf``,
    a written table, fits the look-up limit; above it (document, term) rows meet
    the table by salted keys.
    """
    table = idf.select("term", "idf")
    if stop_words:
        table = table.where(~F.col("term").isin(list(stop_words)))
    size = measured_bytes(table)
    if size <= BROADCAST_BYTES and 0 < table.count() <= MODEL_TERMS:
        joined = vocabulary_counts(df, key, tokens, table)
    else:
        joined = lookup_join(counted_terms(df, key, tokens), table, "term", "inner", size)
    return joined.select(key, "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))
