import struct
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorestream.operators import infer


def jpeg(width, height):
    app = b"\xff\xe0" + struct.pack(">H", 16) + b"JFIF\x00" + b"\x00" * 9
    frame = b"\xff\xc0" + struct.pack(">HBHH", 17, 8, height, width) + b"\x00" * 10
    return b"\xff\xd8" + app + frame


def png(width, height):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", width, height)


def test_image_sizes(spark):
    gif = b"GIF89a" + struct.pack("<HH", 7, 9) + b"\x00"
    filled = b"\xff\xd8\xff\xff" + jpeg(32, 16)[2:]
    data = [jpeg(320, 240), png(5, 6), gif, b"text", b"", None, filled, b"\xff\xd8\xff", png(1, 2)[:20]]
    df = spark.createDataFrame([(i, d and bytearray(d)) for i, d in enumerate(data)], "i int, c binary")
    got = {r.i: (r.s.width, r.s.height) for r in df.select("i", infer.image_size("c").alias("s")).collect()}
    none = (None, None)
    assert got == {0: (320, 240), 1: (5, 6), 2: (7, 9), 3: none, 4: none, 5: none, 6: (32, 16), 7: none, 8: none}


def test_text_payload_size(spark):
    df = spark.createDataFrame([("ab\nabcd\n",), ("",)], "t string")
    sizes = [r.s.asDict() for r in df.select(infer.text_payload_size(F.col("t")).alias("s")).collect()]
    assert sizes == [{"width": 4, "height": 3}, {"width": 0, "height": 1}]


def test_tensor_is_scaled_per_channel(spark):
    pixels = np.arange(32 * 32 * 3, dtype=np.uint32).astype(np.uint8)
    df = spark.createDataFrame([(bytearray(pixels.tobytes()),), (None,), (bytearray(b"short"),)], "c binary")
    rows = df.select(infer.normalized_tensor_udf()("c")).collect()
    cube = pixels.reshape(32, 32, 3) / 255.0
    expected = (cube - [0.485, 0.456, 0.406]) / [0.229, 0.224, 0.225]
    assert np.allclose(rows[0][0], expected.transpose(2, 0, 1).ravel(), atol=1e-6)
    assert rows[1][0] is None and rows[2][0] is None


def test_tensors_are_made_some_rows_at_a_time_whatever_the_batch():
    cells = np.random.default_rng(7).integers(0, 256, (700, 32 * 32 * 3), dtype=np.uint8)
    contents = pd.Series([None if i % 50 == 3 else row.tobytes() for i, row in enumerate(cells)])
    tracemalloc.start()
    sizes, values = [], []
    for part in infer.normalized_tensor_udf().func(iter([contents, contents[:0]])):
        sizes.append(len(part))
        values += [None if tensor is None else float(tensor[1024:2048].sum()) for tensor in part]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = ((cells.reshape(700, 1024, 3)[:, :, 1] / 255.0 - 0.456) / 0.224).astype("float32").sum(axis=1)
    assert sum(sizes) == 700 and max(sizes) <= 200 and peak < 30_000_000
    assert all(v is None if i % 50 == 3 else abs(v - expected[i]) < 0.01 for i, v in enumerate(values))


@pytest.mark.parametrize("batch_size", [1, 7, 64])
def test_inner_batches_do_not_change_predictions(spark, batch_size):
    def load():
        return lambda batch: np.stack([batch[:, 0], batch[:, 1]], axis=1)

    df = spark.range(200).select(
        "id", F.when(F.col("id") % 10 != 3, F.array(F.col("id") % 7.0, F.lit(3.0))).alias("v")
    )
    udf = infer.predict_udf(load, ["first", "second"], ["the first", "the second"], batch_size)
    for row in df.select("id", udf("v").alias("p")).collect():
        if row.id % 10 == 3:
            assert row.p is None or row.p["class"] is None
        else:
            first = row.id % 7 >= 3
            assert row.p["class"] == ("first" if first else "second")
            assert row.p["desc"] == ("the first" if first else "the second")
            assert row.p["score"] == max(row.id % 7, 3)


def test_class_centroids_equal_numpy(spark):
    rows = [(i, i % 3, [float(i), float(i * i)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, label int, v array<float>")
    names, centroids = infer.class_centroids(df, "label", "v")
    assert names == ["0", "1", "2"]
    for k in range(3):
        assert np.allclose(centroids[k], np.mean([r[2] for r in rows if r[1] == k], axis=0))
    with pytest.raises(ValueError):
        infer.class_centroids(df, "id", "v", max_classes=5)
