"""User-supplied models over payload columns, batched through Arrow."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, functions as F, types as T

from scorestream.schemas import IMAGE_SIZE, PREDICTION

#: A model maps a stacked batch to one row of class scores per payload.
Model = Callable[[np.ndarray], np.ndarray]

# Channel means and deviations of the usual image networks.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)

_FIELDS = ["class", "desc", "score"]
#: Bytes of the tensors that are made at a time.
_TENSOR_BYTES = 4_000_000


def predict_udf(
    model_fn: Callable[[], Model],
    classes: Sequence[str],
    descriptions: Sequence[str] | None = None,
    batch_size: int = 64,
    decode: Callable[[object], np.ndarray] = np.asarray,
):
    """Column function: payload -> struct of the best class and its score.

    ``model_fn`` runs once per task; pass ``lambda: model`` to ship a model
    built on the driver.  Null payloads give null results.
    """
    names = np.asarray(list(classes), dtype=object)
    texts = np.asarray(list(descriptions or classes), dtype=object)

    def score(model: Model, payloads: pd.Series) -> pd.DataFrame:
        batch = np.stack([decode(p) for p in payloads])
        scores = np.asarray(model(batch))
        best = scores.argmax(axis=1)
        return pd.DataFrame(
            {
                "class": names[best],
                "desc": texts[best],
                "score": scores[np.arange(len(best)), best].astype("float32"),
            },
            index=payloads.index,
        )

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = model_fn()
        for payloads in batches:
            present = payloads[payloads.notna()]
            parts = [
                score(model, present.iloc[start : start + batch_size])
                for start in range(0, len(present), batch_size)
            ]
            found = pd.concat(parts) if parts else pd.DataFrame(columns=_FIELDS)
            yield found.reindex(payloads.index)

    return predict


def normalized_tensor_udf(
    shape: Sequence[int] = (32, 32, 3),
    mean: Sequence[float] = CHANNEL_MEAN,
    std: Sequence[float] = CHANNEL_STD,
):
    """Column function: height-width-channel bytes -> channel-first floats.

    Bytes are scaled to 0..1, then centred and scaled per channel, some rows at a
    time: what a task holds besides the payloads does not grow with the batches
    of the engine.  A payload of another length than the shape's is null.
    """
    means = np.asarray(mean, dtype="float64")
    stds = np.asarray(std, dtype="float64")
    size = int(np.prod(tuple(shape)))
    step = max(1, _TENSOR_BYTES // (8 * max(1, size)))
    # The value of each byte in each channel.
    levels = ((np.arange(256)[:, None] / 255.0 - means) / stds).astype("float32")
    channels = np.arange(shape[-1])

    def tensors(contents: pd.Series) -> pd.Series:
        present = [c is not None and len(c) == size for c in contents]
        raw = np.frombuffer(b"".join(contents[present]), dtype=np.uint8).reshape((sum(present), *shape))
        scaled = levels[raw, channels].transpose(0, 3, 1, 2).reshape(len(raw), size)
        found = iter(scaled)
        return pd.Series([next(found) if p else None for p in present], index=contents.index, dtype=object)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def normalize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for contents in batches:
            for start in range(0, len(contents), step):
                yield tensors(contents.iloc[start : start + step])

    return normalize


def text_payload_size(text: Column) -> Column:
    """Longest line in bytes and number of lines, as width and height."""
    lines = F.split(text, "\n")
    width = F.array_max(F.transform(lines, F.octet_length))
    return F.struct(width.alias("width"), F.size(lines).alias("height"))


def _jpeg_size(content: bytes | None) -> tuple[int | None, int | None]:
    """Width and height from the first frame header; any number of fill bytes may precede a marker."""
    at = 2
    while content is not None and at + 9 <= len(content) and content[at] == 0xFF:
        marker = content[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", content[at + 5 : at + 9])
            return width, height
        at += 2 + struct.unpack(">H", content[at + 2 : at + 4])[0]
    return None, None


@F.pandas_udf(IMAGE_SIZE)
def _jpeg_sizes(contents: pd.Series) -> pd.DataFrame:
    sizes = pd.DataFrame(list(map(_jpeg_size, contents)), columns=["width", "height"])
    return sizes.astype("Int32")


def image_size(content: str | Column) -> Column:
    """Width and height from a PNG, GIF or JPEG header; null for other bytes.

    Fixed positions are read by plain expressions; only JPEG headers, which have
    to be walked, go to Python.
    """
    column = F.col(content) if isinstance(content, str) else content

    def number(*positions: int) -> Column:
        pieces = F.concat(*(F.hex(F.substring(column, p, 1)) for p in positions))
        return F.conv(pieces, 16, 10).cast("bigint").try_cast("int")

    def sized(width: Column, height: Column) -> Column:
        return F.struct(width.alias("width"), height.alias("height"))

    length = F.octet_length(column)
    png = (F.hex(F.substring(column, 1, 8)) == "89504E470D0A1A0A") & (length >= 24)
    gif = (F.hex(F.substring(column, 1, 4)) == "47494638") & (length >= 10)
    jpeg = F.hex(F.substring(column, 1, 2)) == "FFD8"
    walked = _jpeg_sizes(F.when(jpeg, column))
    return (
        F.when(png, sized(number(17, 18, 19, 20), number(21, 22, 23, 24)))
        .when(gif, sized(number(8, 7), number(10, 9)))
        .otherwise(sized(walked["width"], walked["height"]))
    )


def nearest_centroid(centroids: np.ndarray) -> Model:
    """Scores are negative Euclidean distances to the class centres."""

    def model(batch: np.ndarray) -> np.ndarray:
        return -np.linalg.norm(batch[:, None, :] - centroids[None, :, :], axis=2)

    return model


def cosine_centroid(centroids: np.ndarray) -> Model:
    """Scores are cosines with the class centres."""
    units = centroids / np.linalg.norm(centroids, axis=1, keepdims=True)

    def model(batch: np.ndarray) -> np.ndarray:
        return (batch @ units.T) / np.linalg.norm(batch, axis=1, keepdims=True)

    return model


def class_centroids(df, label: str, vector: str, max_classes: int = 1000):
    """Class names and their mean vectors: one row per vector, summed before it is shuffled.

    The result has one vector per class; the number of classes is checked.
    """
    vectors = df.select(label, array_to_vector(vector).alias("_vector"))
    means = vectors.groupBy(label).agg(vector_to_array(Summarizer.mean(F.col("_vector"))).alias("mean"))
    rows = means.orderBy(label).limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} classes")
    return [str(row[label]) for row in rows], np.array([row["mean"] for row in rows])
