"""Input schemas, stated once for batch readers and for streams."""

from __future__ import annotations

from pyspark.sql import types as T

_FLOWER_MEASURES = ("sepal_length", "sepal_width", "petal_length", "petal_width")


def flower_schema(measure: T.DataType | None = None, target: str = "species") -> T.StructType:
    """Four measurements and a class label."""
    kind = measure or T.FloatType()
    fields = [T.StructField(name, kind) for name in _FLOWER_MEASURES]
    return T.StructType([*fields, T.StructField(target, T.StringType())])


def review_schema(
    stars: T.DataType | None = None, date: T.DataType | None = None
) -> T.StructType:
    """A review with its three vote counts."""
    return T.StructType(
        [
            T.StructField("business_id", T.StringType()),
            T.StructField("cool", T.IntegerType()),
            T.StructField("date", date or T.StringType()),
            T.StructField("funny", T.IntegerType()),
            T.StructField("review_id", T.StringType()),
            T.StructField("stars", stars or T.FloatType()),
            T.StructField("text", T.StringType()),
            T.StructField("useful", T.IntegerType()),
            T.StructField("user_id", T.StringType()),
        ]
    )


#: What a message broker hands to a consumer.
MESSAGE_ENVELOPE = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)

#: What an image or text model returns for one payload.
PREDICTION = T.StructType(
    [
        T.StructField("class", T.StringType()),
        T.StructField("desc", T.StringType()),
        T.StructField("score", T.FloatType()),
    ]
)

#: Width and height of an image.
IMAGE_SIZE = T.StructType(
    [T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]
)

#: Metric rows appended per micro-batch.
BATCH_METRICS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
