"""User-supplied models and payload functions over binary and array columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from scorestream.catalog.registry import query, table
from scorestream.operators.infer import (
    CHANNEL_MEAN,
    CHANNEL_STD,
    class_centroids,
    cosine_centroid,
    image_size,
    nearest_centroid,
    normalized_tensor_udf,
    predict_udf,
    text_payload_size,
)
from scorestream.workspace import spread

_CENTROIDS_SQL = """
cells AS (
    SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x
    FROM embeddings
), centroids AS (
    SELECT label AS class, pos, avg(x) AS m FROM cells GROUP BY label, pos
), compared AS (
    SELECT vec_id, class, -sqrt(sum((x - m) * (x - m))) AS distance_score,
           sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))) AS cosine_score
    FROM cells JOIN centroids USING (pos) GROUP BY vec_id, class
)
"""


def _best_sql(score: str) -> str:
    return (
        f"SELECT vec_id, class, {score} AS score FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY vec_id ORDER BY {score} DESC, class) AS place FROM compared) WHERE place = 1"
    )


def _vectors(spark, sf_dir):
    return spread(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))


def _as_vector(payload):
    return np.asarray(payload, dtype="float64")


def _scored(vectors, udf):
    found = vectors.select("vec_id", udf(F.col("embedding")).alias("found"))
    return found.select(
        "vec_id",
        F.col("found.class").cast("int").alias("label"),
        F.round(F.col("found.score").cast("double"), 3).alias("score"),
    )


@query(
    "nearest_centroid_infer",
    f"""
    WITH {_CENTROIDS_SQL}, best AS ({_best_sql('distance_score')})
    SELECT vec_id, class AS label, round(score::FLOAT::DOUBLE, 3) AS score FROM best
    """,
)
def nearest_centroid_infer(spark, sf_dir):
    """Best class of each vector by an Arrow-batched model loaded once per task."""
    vectors = _vectors(spark, sf_dir)
    names, centroids = class_centroids(vectors, "label", "embedding")
    udf = predict_udf(lambda: nearest_centroid(centroids), names, decode=_as_vector)
    return _scored(vectors, udf)


@query(
    "infer_model_choice",
    f"""
    WITH {_CENTROIDS_SQL}
    SELECT 'distance' AS model, vec_id, class AS label FROM ({_best_sql('distance_score')})
    UNION ALL SELECT 'cosine', vec_id, class FROM ({_best_sql('cosine_score')})
    """,
)
def infer_model_choice(spark, sf_dir):
    """Two models, given as loaders, in one pass over the vectors."""
    vectors = _vectors(spark, sf_dir)
    names, centroids = class_centroids(vectors, "label", "embedding")
    loaders = {"distance": nearest_centroid, "cosine": cosine_centroid}
    found = vectors.select(
        "vec_id",
        *(
            predict_udf(lambda load=load: load(centroids), names, decode=_as_vector)(
                F.col("embedding")
            )["class"].cast("int").alias(name)
            for name, load in loaders.items()
        ),
    )
    return found.unpivot("vec_id", list(loaders), "model", "label")


@query(
    "payload_shape",
    """
    SELECT page_id, list_max(list_transform(string_split(html, chr(10)), lambda x: strlen(x)))::INTEGER AS width,
           len(string_split(html, chr(10)))::INTEGER AS height
    FROM pages
    """,
)
def payload_shape(spark, sf_dir):
    """Width and height of a text payload: longest line in bytes, number of lines."""
    pages = table(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", text_payload_size(F.col("html")).alias("size")).select(
        "page_id", "size.*"
    )


@query(
    "image_header_size",
    "SELECT doc_id, n_chars::INTEGER AS width, length(source)::INTEGER AS height FROM documents",
)
def image_header_size(spark, sf_dir):
    """Size read from image bytes, here headers built from two numbers of each document."""

    def word(value):
        return F.lpad(F.hex(value), 8, "0")

    documents = table(spark, sf_dir, "documents", "doc_id", "n_chars", "source")
    # The PNG signature and the length and name of its first chunk.
    header = F.concat(
        F.lit("89504E470D0A1A0A0000000D49484452"), word(F.col("n_chars")), word(F.length("source"))
    )
    images = documents.select("doc_id", F.unhex(header).alias("content"))
    return images.select("doc_id", image_size("content").alias("size")).select("doc_id", "size.*")


_MEAN = (*CHANNEL_MEAN, 0.5)
_STD = (*CHANNEL_STD, 0.25)


@query(
    "tensor_normalize",
    f"""
    WITH cells AS (
        SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings
    ), bytes AS (
        SELECT vec_id, i // 4 AS spot, i % 4 AS channel,
               greatest(0, least(255, floor((x + 1) * 127.5)))::INTEGER AS b
        FROM cells
    )
    SELECT vec_id, (channel * 16 + spot)::INTEGER AS place,
           round(((b / 255.0::DOUBLE - list_value{_MEAN}[channel + 1]) / list_value{_STD}[channel + 1])::FLOAT::DOUBLE, 3) AS value
    FROM bytes
    """,
)
def tensor_normalize(spark, sf_dir):
    """Raw bytes of a 4 x 4 grid with four channels to channel-first scaled floats."""
    vectors = _vectors(spark, sf_dir)

    def byte(x):
        scaled = F.floor((x.cast("double") + 1) * 127.5)
        return F.lpad(F.hex(F.greatest(F.lit(0), F.least(F.lit(255), scaled))), 2, "0")

    payload = F.unhex(F.array_join(F.transform("embedding", byte), ""))
    tensor = normalized_tensor_udf((4, 4, 4), _MEAN, _STD)
    values = vectors.select("vec_id", payload.alias("content")).select(
        "vec_id", F.posexplode(tensor("content")).alias("place", "value")
    )
    return values.select("vec_id", "place", F.round(F.col("value").cast("double"), 3).alias("value"))


@query(
    "image_header_formats",
    """
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN NULL ELSE (n_chars % 65536)::INTEGER END AS width,
           CASE doc_id % 3 WHEN 0 THEN NULL ELSE length(source)::INTEGER END AS height
    FROM documents
    """,
)
def image_header_formats(spark, sf_dir):
    """Sizes from GIF and JPEG headers built from two numbers of each document; cut-off headers have none."""
    documents = table(spark, sf_dir, "documents", "doc_id", "n_chars", "source")
    wide, high = F.lpad(F.hex(F.col("n_chars") % 65536), 4, "0"), F.lpad(F.hex(F.length("source")), 4, "0")

    def turned(word):
        return F.concat(F.substring(word, 3, 2), F.substring(word, 1, 2))

    # The GIF signature; JPEG start, an application segment of 16 bytes, the head of a frame.
    gif = F.concat(F.lit("474946383961"), turned(wide), turned(high))
    jpeg = F.concat(F.lit("FFD8FFE00010" + "00" * 14 + "FFC0001108"), high, wide, F.lit("03"))
    cut = F.substring(jpeg, 1, 40)
    kind = F.col("doc_id") % 3
    images = documents.select("doc_id", F.unhex(F.when(kind == 0, cut).when(kind == 1, gif).otherwise(jpeg)).alias("content"))
    return images.select("doc_id", image_size("content").alias("size")).select("doc_id", "size.*")


@query(
    "image_tensor_normalize",
    f"""
    WITH cells AS (
        SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings
    ), bytes AS (
        SELECT vec_id, k * 64 + i AS place, (greatest(0, least(255, floor((x + 1) * 127.5)))::INTEGER + 5 * k) % 256 AS b
        FROM cells, range(48) AS tiles(k)
    ), scaled AS (
        SELECT vec_id, place % 3 AS channel, place // 3 AS spot,
               ((b / 255.0::DOUBLE - list_value{CHANNEL_MEAN}[place % 3 + 1]) / list_value{CHANNEL_STD}[place % 3 + 1])::FLOAT::DOUBLE AS v
        FROM bytes
    )
    SELECT vec_id, channel::INTEGER AS channel, round(sum(v), 3) AS total, round(sum(v * spot), 1) AS weighted
    FROM scaled GROUP BY vec_id, channel
    """,
)
def image_tensor_normalize(spark, sf_dir):
    """Images of 32 x 32 pixels and three channels: every channel's sum, plain and weighted by place."""
    vectors = _vectors(spark, sf_dir)
    grey = F.transform(
        "embedding",
        lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 1) * 127.5))),
    )
    tiles = F.flatten(
        F.transform(F.sequence(F.lit(0), F.lit(47)), lambda k: F.transform("grey", lambda b: (b + 5 * k) % 256))
    )
    payload = F.unhex(F.array_join(F.transform(tiles, lambda b: F.lpad(F.hex(b), 2, "0")), ""))
    images = vectors.select("vec_id", grey.alias("grey")).select("vec_id", payload.alias("content"))
    cells = images.select("vec_id", F.posexplode(normalized_tensor_udf()("content")).alias("place", "v"))
    channel, spot, value = F.expr("place div 1024"), F.col("place") % 1024, F.col("v").cast("double")
    return cells.groupBy("vec_id", channel.cast("int").alias("channel")).agg(
        F.round(F.sum(value), 3).alias("total"), F.round(F.sum(value * spot), 1).alias("weighted")
    )
