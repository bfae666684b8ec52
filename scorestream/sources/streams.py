"""Streaming readers.  Any source that yields the message envelope will do."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorestream.schemas import MESSAGE_ENVELOPE


def stream_source(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str | None = None,
    fail_on_data_loss: bool | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a topic subscription.

    Left out, the start is the latest offset and lost data is an error.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_offsets is not None:
        options["startingOffsets"] = starting_offsets
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_source(spark: SparkSession, servers: str, topic: str, **options: Any) -> DataFrame:
    """Topic as a stream; needs the Kafka connector on the class path."""
    return stream_source(spark, "kafka", options=kafka_options(servers, topic, **options))


def message_replay(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Published message files as a stream, a bounded number per micro-batch."""
    options = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
    return stream_source(spark, "parquet", path, MESSAGE_ENVELOPE, options)


def files_per_trigger(spark: SparkSession, path: str, least: int, batches: int) -> int:
    """Files of a micro-batch, ``least`` or more, so that what lies in a folder is taken in about ``batches`` of them.

    A micro-batch has costs of its own besides those of its rows: plans, commits,
    a pass over the state.  A fixed number of files makes their number grow with
    the input, and the passes over the state with its square.
    """
    return max(least, -(-len(spark.read.schema(MESSAGE_ENVELOPE).parquet(path).inputFiles()) // batches))


def arriving_files(
    spark: SparkSession, path: str, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """Files as they land in a folder, with their bytes.

    The engine's file sources pass over files of length zero.
    """
    options: dict[str, Any] = {"recursiveFileLookup": True}
    if glob:
        options["pathGlobFilter"] = glob
    if files_per_trigger:
        options["maxFilesPerTrigger"] = files_per_trigger
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("modificationTime", T.TimestampType()),
            T.StructField("length", T.LongType()),
            T.StructField("content", T.BinaryType()),
        ]
    )
    return stream_source(spark, "binaryFile", path, schema, options)


def text_lines(
    spark: SparkSession, path: str, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """(path, length, line) of text files as they land; large files are split over tasks.

    The engine's file sources pass over files of length zero, so these have no row.
    """
    options: dict[str, Any] = {"recursiveFileLookup": True, "lineSep": "\n"}
    if glob:
        options["pathGlobFilter"] = glob
    if files_per_trigger:
        options["maxFilesPerTrigger"] = files_per_trigger
    schema = T.StructType([T.StructField("value", T.StringType())])
    lines = stream_source(spark, "text", path, schema, options)
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.col("value").alias("line")
    )
