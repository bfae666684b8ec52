"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorestream.llm import (
    collocation,
    divergence,
    frames,
    hilbert,
    language,
    private,
    quality,
    simhash,
    templates,
    tokens,
    toxicity,
    vantage,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def op1_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.documents(spark, sf_dir, "doc_id", "text", "lang")
    trees = language.fit_trees(docs)
    found = language.identify(docs, trees)
    return found.select(
        "doc_id",
        frames.in_held_out_fold(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "bits_per_byte",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(frames.documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(
        frames.documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_decode(
        frames.documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        digests=True,
    )


NEAREST_SQL = """
WITH usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.v, c.v)
             / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v))) AS score
    FROM usable q, usable c
    WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
           vec_id, score
    FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op4_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = frames.read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vantage.nearest(vectors, F.col("vec_id") % 50 == 0)


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.curve_shards(frames.read_table(spark, sf_dir, "documents"))


def op6_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = frames.read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return templates.contaminated(frames.documents(spark, sf_dir), items)


def op7_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(frames.read_table(spark, sf_dir, "pages"))


def op9_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.documents(spark, sf_dir)
    labels = frames.read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))
    return scored.select(
        "doc_id", frames.in_held_out_fold(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op10_skip_chain_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.documents(spark, sf_dir)
    return private.find_private(docs, private.fit_field(docs))


PHRASES_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM pieces),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
sized AS (SELECT lang, words, i, unnest([1, 2, 3, 4]) AS size FROM placed),
counted AS (
    SELECT lang, size, list_slice(words, i, i + size - 1) AS words, count(*) AS f
    FROM sized WHERE i + size - 1 <= len(words) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
often AS (SELECT * FROM counted WHERE f >= 30),
candidates AS (SELECT lang, size, words, f AS a FROM often WHERE size > 1),
parts AS (
    SELECT c.lang, c.size, c.words, c.a, k, lf.f AS l, rf.f AS r,
           (2000000::HUGEINT * c.a) // (lf.f + rf.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN often lf ON lf.lang = c.lang AND lf.words = list_slice(c.words, 1, k)
    JOIN often rf ON rf.lang = c.lang AND rf.words = list_slice(c.words, k + 1, c.size)),
weakest AS (
    SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inside AS (
    SELECT lang, a, list_slice(words, s, s + z - 1) AS words
    FROM (SELECT *, unnest(range(1, size - z + 2)) AS s
          FROM (SELECT *, unnest(range(2, size)) AS z FROM candidates))),
covered AS (SELECT lang, words, max(a) AS a FROM inside GROUP BY ALL),
left_over AS (
    SELECT w.* FROM weakest w LEFT JOIN covered c ON c.lang = w.lang AND c.words = w.words
    WHERE c.a IS NULL OR 100::HUGEINT * c.a < 80::HUGEINT * w.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank,
           array_to_string(words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
    FROM left_over JOIN totals USING (lang))
WHERE rank <= 2000
"""


def op11_phrase_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(frames.documents(spark, sf_dir, "lang", "text"))


def op12_leader_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.documents(spark, sf_dir)
    labels = frames.read_table(spark, sf_dir, "labels", "doc_id", "quality")
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
    return scored.select(
        "doc_id", quality.in_held_out_third(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


DIVERGENCE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
worded AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM worded GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
held AS (
    SELECT lang, source, term, count(*) AS n FROM worded SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS n FROM groups g LEFT JOIN held USING (lang, source) GROUP BY ALL),
dense AS (
    SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 1)) // (s.n + l.v) AS p,
           1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) JOIN sums s USING (lang, source)
    LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
    FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (FROM pairs UNION ALL FROM terms))
WHERE part = 'pair' OR rank <= 200
"""


def op13_cube_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_audit(frames.documents(spark, sf_dir, "lang", "source", "text"))


QUERIES: dict[str, Query] = {
    "op1_ppm_language": op1_ppm_language,
    "op2_simhash": op2_simhash,
    "op3_token_counts": op3_token_counts,
    "op4_vantage_neighbours": op4_vantage_neighbours,
    "op5_hilbert_shards": op5_hilbert_shards,
    "op6_template_leaks": op6_template_leaks,
    "op7_zip_warc": op7_zip_warc,
    "op8_piece_codec": op8_piece_codec,
    "op9_string_kernel_toxicity": op9_string_kernel_toxicity,
    "op10_skip_chain_private": op10_skip_chain_private,
    "op11_phrase_streams": op11_phrase_streams,
    "op12_leader_quality": op12_leader_quality,
    "op13_cube_divergence": op13_cube_divergence,
}

ORACLES: dict[str, str] = {
    "op4_vantage_neighbours": NEAREST_SQL,
    "op11_phrase_streams": PHRASES_SQL,
    "op13_cube_divergence": DIVERGENCE_SQL,
}
