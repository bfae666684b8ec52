"""What lands in a folder, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from scorestream.functions.encode import base64_text, text_base64
from scorestream.sources.sinks import batch_sink, state_folder, write_batch


def arrival_events(files: DataFrame) -> DataFrame:
    """A notification per new file: its path as base64."""
    return files.select(text_base64(F.col("path")).alias("data"))


def event_paths(events: DataFrame) -> DataFrame:
    """Paths carried by notifications."""
    return events.select(base64_text(F.col("data")).alias("path"))


def file_lines(lines: DataFrame) -> DataFrame:
    """Path, size and number of lines of each file, from its lines as ``text_lines`` reads them.

    A line break at the end begins one more, empty line.  Files are split over
    tasks and their counts combined, so no file has to fit one of them.
    """
    counted = lines.groupBy("path", "length").agg(
        F.count("*").alias("n_rows"), F.sum(F.octet_length("line")).alias("n_bytes")
    )
    ends_open = F.col("length") == F.col("n_bytes") + F.col("n_rows")
    return counted.select("path", "length", (F.col("n_rows") + ends_open.cast("bigint")).alias("n_lines"))


def file_lines_stream(lines: DataFrame, path: str, checkpoint: str | None = None, **options) -> StreamingQuery:
    """Write the line counts of the files of every micro-batch below ``path``.

    A file arrives within one micro-batch, so its counts are final.
    """
    checkpoint = checkpoint or state_folder(path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(file_lines(batch), path, batch_id, checkpoint)

    return batch_sink(lines, handle, checkpoint, **options)
