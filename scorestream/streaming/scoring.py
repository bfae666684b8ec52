"""Apply fitted models to streams and keep score."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from scorestream.functions.labels import correct_flag, percent_text
from scorestream.operators.metrics import batch_metrics
from scorestream.sources.sinks import batch_sink, state_folder, write_batch


def score_stream(stream: DataFrame, *models: PipelineModel, drop: Sequence[str] = ("rawPrediction", "probability")) -> DataFrame:
    """Models applied in turn; stateless, so it runs in append mode."""
    for model in models:
        stream = model.transform(stream)
    return stream.drop(*drop)


def with_correct(df: DataFrame, label: str, prediction: str = "prediction", classes: Iterable | None = None) -> DataFrame:
    return df.withColumn("correct", correct_flag(F.col(prediction), F.col(label), classes))


def running_accuracy(scored: DataFrame, flag: str = "correct") -> DataFrame:
    """One row: accuracy so far as text, plus the number of rows.

    Partial sums are combined before the shuffle and the state is one row.
    """
    return scored.agg(F.count("*").alias("n_rows"), percent_text(F.col(flag)).alias("accuracy"))


def metric_stream(
    scored: DataFrame,
    path: str,
    label: str,
    prediction: str = "prediction",
    scale: float = 1.0,
    checkpoint: str | None = None,
    **options,
) -> StreamingQuery:
    """Write (metric, value) rows of every micro-batch below ``path``.

    The state is kept below ``path`` as well unless ``checkpoint`` is given.
    """
    checkpoint = checkpoint or state_folder(path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch_metrics(batch, batch_id, label, prediction, scale)
        write_batch(rows.drop("batch_id"), path, batch_id, checkpoint)

    return batch_sink(scored, handle, checkpoint, **options)


def raw_and_scored_stream(
    scored: DataFrame,
    raw_path: str,
    scored_path: str,
    raw_columns: Sequence[str],
    scored_columns: Sequence[str],
    checkpoint: str | None = None,
    **options,
) -> StreamingQuery:
    """Two outputs from one reading of the source.

    The batch is scored once and kept while both outputs are written.  The state
    is kept below ``scored_path`` unless ``checkpoint`` is given.
    """
    checkpoint = checkpoint or state_folder(scored_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch.select(*raw_columns), raw_path, batch_id, checkpoint)
            write_batch(batch.select(*scored_columns), scored_path, batch_id, checkpoint)
        finally:
            batch.unpersist()

    return batch_sink(scored, handle, checkpoint, **options)


def snapshot_stream(
    aggregated: DataFrame, path: str, mode: str = "complete", checkpoint: str | None = None, **options
) -> StreamingQuery:
    """Store the result of a stateful aggregate after every micro-batch; state as in ``metric_stream``."""
    checkpoint = checkpoint or state_folder(path)
    return batch_sink(
        aggregated, lambda batch, i: write_batch(batch, path, i, checkpoint), checkpoint, mode, **options
    )


def last_snapshot(spark, path: str) -> DataFrame:
    """The newest state that one stream has written by ``snapshot_stream``."""
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max("batch_id").alias("b")).scalar()
    return rows.where(F.col("batch_id") == newest).drop("batch_id", "stream")
