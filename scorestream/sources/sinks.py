"""Batch and streaming writers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from scorestream.functions.encode import encode_utf8, row_delimited, row_json


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Print the schema and the first rows."""
    df.printSchema()
    df.show(n, truncate)


def json_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON message in the (key, value) envelope."""
    return _envelope(df, key, row_json(*df.columns))


def delimited_messages(df: DataFrame, key: str | None = None, delimiter: str = ",") -> DataFrame:
    """Each row as one delimited line, quoted where an item needs it; nulls stay nulls."""
    return _envelope(df, key, row_delimited(df.columns, delimiter))


def line_messages(df: DataFrame, line: str = "value") -> DataFrame:
    """Text lines as messages, empty lines dropped."""
    lines = df.where(F.col(line) != "")
    return _envelope(lines, None, F.col(line))


def _envelope(df: DataFrame, key: str | None, value: Column) -> DataFrame:
    name = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(encode_utf8(name).alias("key"), encode_utf8(value).alias("value"))


def publish(
    messages: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, Any] | None = None,
) -> None:
    """Send messages to a topic or a folder, straight from the executors."""
    writer = messages.write.format(fmt).options(**(options or {})).mode("append")
    writer.save(path) if path else writer.save()


def stream_sink(
    df: DataFrame,
    fmt: str,
    mode: str = "append",
    path: str | None = None,
    name: str | None = None,
    checkpoint: str | None = None,
    trigger: Mapping[str, Any] | None = None,
    options: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Start a query into a console, memory, file or topic sink.

    A file sink keeps its state below its own path unless told otherwise, so
    that the same call goes on where it stopped.  Console and memory sinks are
    for looking only and may do without; any other sink needs a ``checkpoint``.
    """
    if checkpoint is None and path:
        checkpoint = state_folder(path)
    if checkpoint is None and fmt not in ("console", "memory"):
        raise ValueError(f"a stream into {fmt!r} needs a checkpoint folder")
    writer = _writer(df, mode, name, checkpoint, trigger).format(fmt).options(**(options or {}))
    return writer.start(path) if path else writer.start()


def batch_sink(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    name: str | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to a function.

    Offsets, state and batch numbers live in ``checkpoint``; started again with
    the same folder, the query goes on where it stopped.
    """
    return _writer(df, mode, name, checkpoint, trigger).foreachBatch(handle).start()


def _writer(
    df: DataFrame,
    mode: str,
    name: str | None,
    checkpoint: str | None,
    trigger: Mapping[str, Any] | None,
) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger) if trigger else writer


def state_folder(path: str) -> str:
    """Where a stream that writes to ``path`` keeps its state; readers of ``path`` pass over it."""
    return f"{path.rstrip('/')}/_state"


def write_batch(df: DataFrame, path: str, batch_id: int, checkpoint: str) -> None:
    """Store one micro-batch in a folder named by its number and by the stream's checkpoint.

    A replay of the batch replaces it; a stream with another checkpoint, whose
    numbers begin at 0 again, writes beside it.
    """
    stream = hashlib.sha1(checkpoint.encode("utf-8")).hexdigest()[:12]
    df.write.mode("overwrite").parquet(f"{path}/stream=s{stream}/batch_id={batch_id}")
