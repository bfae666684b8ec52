"""Helpers shared by the operators: row selection, folds, Arrow text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def keyed_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the key and the text, so that further columns cannot clash with results."""
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def in_held_out_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def byte_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string column, and where each row starts and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch one by one, so that only one copy is alive; null is empty."""
    for value in batch.column(column):
        yield value.as_py() or ""


def capped_cache(cache: dict, limit: int) -> None:
    """Empty a memo table that has outgrown its limit."""
    if len(cache) > limit:
        cache.clear()
