"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes what its predecessor kept and returns the columns of
``documents``; the last returns token ids in place of the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorestream.llm import frames, language, private, simhash, templates, tokens
from scorestream.workspace import materialize


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that some learned language codes better than plain byte classes would.

    Null texts, texts without a letter and noise go; ``lang`` becomes the
    predicted language.  Without any labelled document there is no language to
    tell, and documents with a letter stay as they are.
    """
    trees = language.fit_trees(docs)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not trees.languages:
        return docs.where(lettered)
    return language.with_language(docs.where(lettered), trees)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one whose id names the group.

    Rows that share an id are judged by their own texts; rows with a null id
    belong to no group and stay.
    """
    return simhash.without_near_copies(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, verbatim or with other values.

    A text decides for itself, whatever its id: rows with a null or a repeated id
    are judged like any other, null and empty texts stay.
    """
    items = frames.read_table(spark, sf_dir, "benchmark", "item_id", "text")
    digest = F.md5(docs["text"].cast("binary"))
    leaks = templates.contaminated(docs.select(digest.alias("doc_id"), "text"), items).select("doc_id").distinct()
    return docs.join(leaks, digest == leaks["doc_id"], "left_anti")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; ``n_chars`` follows, null for a null text."""
    field = private.fit_field(docs)
    return private.redact(docs, field).withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): the texts as token ids, decoded again as a check.

    A null text has no ids, like an empty one; every row stays.
    """
    return tokens.with_codes(
        docs.select("doc_id", "lang", "source", "text"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


STAGES = [
    ("language", spoken),
    ("near_copies", distinct),
    ("benchmark_leaks", unleaked),
    ("personal_data", redacted),
    ("tokens", encoded),
]

#: Code lengths, fingerprints, the field and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
