"""Tokens, stems, vocabularies and term weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorestream.catalog.registry import query, table
from scorestream.catalog.stop_list import ENGLISH
from scorestream.functions.stem import stem_word
from scorestream.functions.text import (
    document_tokens,
    finish_tokens,
    normalize_tokens,
    without_words,
    word_tokens,
)
from scorestream.operators import terms
from scorestream.operators.features import stemmed_tokens
from scorestream.workspace import materialize, spread

STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + ")"

#: Tokens of every document, as CTEs named raw_tokens and tokens (no stop words).
TOKENS_SQL = rf"""
raw_tokens AS (
    SELECT doc_id, lang, term FROM (
        SELECT doc_id, lang, unnest(regexp_split_to_array(lower(text), '\W+')) AS term FROM documents
    ) WHERE term <> ''
), tokens AS (
    SELECT * FROM raw_tokens WHERE term NOT IN {STOP_SQL}
)
"""


def documents(spark, sf_dir, *columns):
    return spread(table(spark, sf_dir, "documents", "doc_id", *columns, "text"))


def words():
    return word_tokens(F.col("text"))


@query(
    "tokenize_terms",
    f"WITH {TOKENS_SQL} SELECT term, count(*) AS n FROM tokens GROUP BY term",
)
def tokenize_terms(spark, sf_dir):
    rows = terms.explode_terms(
        documents(spark, sf_dir), words(), stop_words=terms.english_stop_words()
    )
    return rows.groupBy("term").agg(F.count("*").alias("n"))


@query(
    "tokens_per_document",
    f"""
    WITH {TOKENS_SQL}
    SELECT d.doc_id, count(r.term)::INTEGER AS n_tokens, count(DISTINCT r.term)::INTEGER AS n_distinct,
           (count(r.term) FILTER (WHERE r.term NOT IN {STOP_SQL}))::INTEGER AS n_kept
    FROM documents d LEFT JOIN raw_tokens r ON r.doc_id = d.doc_id GROUP BY d.doc_id
    """,
)
def tokens_per_document(spark, sf_dir):
    tokens = documents(spark, sf_dir).select("doc_id", words().alias("tokens"))
    kept = without_words(F.col("tokens"), terms.english_stop_words())
    return tokens.select(
        "doc_id",
        F.size("tokens").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).alias("n_distinct"),
        F.size(kept).alias("n_kept"),
    )


_COUNTS_SQL = """
counts AS (
    SELECT term, count(*) AS cf, count(DISTINCT doc_id) AS df FROM tokens GROUP BY term
), vocab AS (
    SELECT * FROM counts WHERE df >= 5 ORDER BY cf DESC, term LIMIT 10000
), weighted AS (
    SELECT term, cf, df, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (df + 1)) AS idf FROM vocab
)
"""


def _counts(spark, sf_dir):
    return terms.term_counts(documents(spark, sf_dir), words(), terms.english_stop_words())


def _stored_counts(spark, sf_dir):
    return materialize(_counts(spark, sf_dir), "term-counts")


def _weighted_vocabulary(spark, sf_dir):
    frequent = terms.vocabulary(_stored_counts(spark, sf_dir))
    return terms.with_idf(frequent, table(spark, sf_dir, "documents", "doc_id"))


@query(
    "term_doc_freq",
    f"WITH {TOKENS_SQL}, {_COUNTS_SQL} SELECT term, cf, df FROM counts",
)
def term_doc_freq(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(
    "vocabulary_top",
    f"WITH {TOKENS_SQL}, {_COUNTS_SQL} SELECT term, cf, df FROM vocab",
)
def vocabulary_top(spark, sf_dir):
    """At most 10,000 terms that occur in five documents or more."""
    return terms.vocabulary(_stored_counts(spark, sf_dir))


@query(
    "idf_weights",
    f"WITH {TOKENS_SQL}, {_COUNTS_SQL} SELECT term, df, round(idf, 9) AS idf FROM weighted",
)
def idf_weights(spark, sf_dir):
    return _weighted_vocabulary(spark, sf_dir).select("term", "df", F.round("idf", 9).alias("idf"))


@query(
    "tfidf",
    f"""
    WITH {TOKENS_SQL}, {_COUNTS_SQL}
    SELECT doc_id, term, count(*) AS tf, round(count(*) * any_value(idf), 6) AS tfidf
    FROM tokens JOIN weighted USING (term) GROUP BY doc_id, term
    """,
)
def tfidf(spark, sf_dir):
    idf = materialize(_weighted_vocabulary(spark, sf_dir).select("term", "idf"), "idf")
    weights = terms.term_weights(documents(spark, sf_dir), "doc_id", words(), idf)
    return weights.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


_NORMAL_SQL = r"""
split_tokens AS (
    SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS parts
    FROM documents
), normal AS (
    SELECT doc_id, list_filter(
        list_transform(parts, lambda x: regexp_replace(x, '[^\p{L}]', '', 'g')), lambda x: x <> ''
    ) AS words
    FROM split_tokens
)
"""


@query(
    "normalize_tokens",
    f"""
    WITH {_NORMAL_SQL}
    SELECT doc_id, len(words)::INTEGER AS n_words, md5(array_to_string(words, ' ')) AS digest FROM normal
    """,
)
def normalize(spark, sf_dir):
    """Letters-only tokens, finished to one string per document."""
    tokens = documents(spark, sf_dir).select(
        "doc_id", normalize_tokens(document_tokens(F.col("text"))).alias("words")
    )
    return tokens.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.md5(finish_tokens(F.col("words"))).alias("digest"),
    )


def stem_sql(source: str) -> str:
    """The suffix rules of Porter (1980) in SQL, from a table of words to (word, stem).

    One CTE per step; ``source`` is the name of a CTE with a column ``word``.
    """
    c, v = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
    m0 = f"^({c})?{v}{c}"
    m1 = f"^({c})?{v}{c}({v})?$"
    m2 = f"^({c})?{v}{c}{v}{c}"
    vowel = f"^({c})?[aeiouy]"
    cvc = f"^{c}[aeiouy][^aeiouwxy]$"

    def cut(n, w="w"):
        return f"left({w}, length({w}) - {n})"

    def has(text, pattern):
        return f"regexp_matches({text}, '{pattern}')"

    def repair(x):
        return (
            f"CASE WHEN {has(x, '(at|bl|iz)$')} THEN {x} || 'e' "
            f"WHEN length({x}) > 1 AND {x}[-1] = {x}[-2] AND {has(x, '[^aeiou]$')} "
            f"AND NOT {has(x, '[lsz]$')} THEN {cut(1, x)} "
            f"WHEN {has(x, m1)} AND {has(x, cvc)} THEN {x} || 'e' ELSE {x} END"
        )

    def rules(pairs, condition):
        branches = " ".join(
            f"WHEN suffix(w, '{old}') THEN CASE WHEN {has(cut(len(old)), condition)} "
            f"THEN {cut(len(old))} || '{new}' ELSE w END"
            for old, new in sorted(pairs, key=lambda pair: -len(pair[0]))
        )
        return f"CASE {branches} ELSE w END"

    step2 = [
        ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
        ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
        ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
        ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ]
    step3 = [
        ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
        ("ness", ""),
    ]
    step4 = [
        (s, "") for s in (
            "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou",
            "ism", "ate", "iti", "ous", "ive", "ize",
        )
    ]
    ion = (
        f"CASE WHEN suffix(w, 'sion') OR suffix(w, 'tion') THEN "
        f"CASE WHEN {has(cut(3), m2)} THEN {cut(3)} ELSE w END ELSE {rules(step4, m2)} END"
    )
    steps = [
        f"CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN {cut(2)} WHEN suffix(w, 'ss') THEN w "
        f"WHEN suffix(w, 's') THEN {cut(1)} ELSE w END",
        f"CASE WHEN suffix(w, 'eed') THEN CASE WHEN {has(cut(3), m0)} THEN {cut(1)} ELSE w END "
        f"WHEN suffix(w, 'ed') THEN CASE WHEN {has(cut(2), vowel)} THEN {repair(cut(2))} ELSE w END "
        f"WHEN suffix(w, 'ing') THEN CASE WHEN {has(cut(3), vowel)} THEN {repair(cut(3))} ELSE w END "
        f"ELSE w END",
        f"CASE WHEN suffix(w, 'y') AND {has(cut(1), vowel)} THEN {cut(1)} || 'i' ELSE w END",
        rules(step2, m0),
        rules(step3, m0),
        ion,
        f"CASE WHEN suffix(w, 'e') AND ({has(cut(1), m2)} OR ({has(cut(1), m1)} "
        f"AND NOT {has(cut(1), cvc)})) THEN {cut(1)} ELSE w END",
        f"CASE WHEN suffix(w, 'll') AND {has('w', m2)} THEN {cut(1)} ELSE w END",
    ]
    ctes = [f"s0 AS (SELECT DISTINCT word, word AS w FROM {source})"]
    ctes += [
        f"s{i} AS (SELECT word, CASE WHEN length(word) > 2 THEN {step} ELSE w END AS w FROM s{i - 1})"
        for i, step in enumerate(steps, 1)
    ]
    return ", ".join(ctes) + f", stems AS (SELECT word, w AS stem FROM s{len(steps)})"


WORDS_SQL = rf"{_NORMAL_SQL}, placed AS (SELECT doc_id, unnest(list_transform(words, lambda x: lower(x))) AS word, generate_subscripts(words, 1) AS place FROM normal)"


@query(
    "stem_vocabulary",
    f"WITH {WORDS_SQL}, {stem_sql('placed')} SELECT word, stem FROM stems",
)
def stem_vocabulary(spark, sf_dir):
    """Every distinct word with its stem; each word is stemmed once."""
    tokens = normalize_tokens(document_tokens(F.col("text")), lower=True)
    vocabulary = (
        documents(spark, sf_dir).select(F.explode(F.array_distinct(tokens)).alias("word")).distinct()
    )
    return vocabulary.select("word", stem_word(F.col("word")).alias("stem"))


@query(
    "stem_documents",
    f"""
    WITH {WORDS_SQL}, {stem_sql('placed')}, joined AS (
        SELECT doc_id, string_agg(stem, ' ' ORDER BY place) AS finished
        FROM placed JOIN stems USING (word) GROUP BY doc_id
    )
    SELECT d.doc_id, md5(coalesce(finished, '')) AS digest
    FROM documents d LEFT JOIN joined USING (doc_id)
    """,
)
def stem_documents(spark, sf_dir):
    """Stemmed documents, in word order, without a shuffle."""
    finished = finish_tokens(stemmed_tokens(F.col("text")))
    return documents(spark, sf_dir).select("doc_id", F.md5(finished).alias("digest"))
