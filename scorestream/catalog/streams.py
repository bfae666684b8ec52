"""Streaming queries: run to the end of the input, then read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from scorestream.catalog.bayes import GAUSSIAN_SQL, TERM_PREDICTION_SQL, fit_shape
from scorestream.catalog.columns import stored_shape
from scorestream.catalog.learn import language_models, language_name
from scorestream.catalog.registry import query, table
from scorestream.catalog.text import documents
from scorestream.operators.features import SHAPE_COLUMNS
from scorestream.sources.sinks import (
    delimited_messages,
    json_messages,
    publish,
    stream_sink,
)
from scorestream.sources.streams import files_per_trigger, message_replay, text_lines
from scorestream.streaming.arrivals import file_lines_stream
from scorestream.streaming.messages import parse_delimited_messages, parse_json_messages
from scorestream.streaming.monitor import TimingListener, batch_timing
from scorestream.streaming.scoring import (
    last_snapshot,
    metric_stream,
    raw_and_scored_stream,
    running_accuracy,
    score_stream,
    snapshot_stream,
    with_correct,
)
from scorestream.workspace import scratch_path

_ALL = {"availableNow": True}
#: Rows per message file and files per micro-batch of the replays below.
_ROWS_PER_FILE = 5000
_FILES_PER_TRIGGER = 8
#: With more files than give so many micro-batches, a micro-batch takes more files.
_BATCHES = 24

_SHAPE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        *(T.StructField(c, T.DoubleType()) for c in SHAPE_COLUMNS),
    ]
)
_TEXT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def _replay(spark, messages, name, files=_FILES_PER_TRIGGER):
    """Publish messages to a folder and read the folder as a stream."""
    path = scratch_path(spark, name)
    publish(messages, path, options={"maxRecordsPerFile": _ROWS_PER_FILE})
    return message_replay(spark, path, files_per_trigger(spark, path, files, _BATCHES))


def _finish(streaming_query):
    streaming_query.awaitTermination()


def _scored_shapes(spark, sf_dir, files=_FILES_PER_TRIGGER):
    """A stream of measurement messages with predicted language and flag."""
    rows = stored_shape(spark, sf_dir)
    model = fit_shape(rows)
    stream = parse_json_messages(_replay(spark, json_messages(rows, "doc_id"), "shapes", files), _SHAPE)
    return with_correct(model.predict(stream), "lang")


@query(
    "stream_running_accuracy",
    f"""
    WITH {GAUSSIAN_SQL}
    SELECT count(*) AS n_rows,
           format('{{:,.2f}}', avg(CASE WHEN prediction = lang THEN 1 ELSE 0 END) * 100) AS accuracy
    FROM predicted
    """,
)
def stream_running_accuracy(spark, sf_dir):
    """Accuracy over all messages so far, complete mode; the last state is returned."""
    path = scratch_path(spark, "accuracy")
    accuracy = running_accuracy(_scored_shapes(spark, sf_dir))
    _finish(snapshot_stream(accuracy, path, name="accuracy", trigger=_ALL))
    return last_snapshot(spark, path)


@query(
    "stream_accuracy_by_class",
    f"""
    WITH {GAUSSIAN_SQL}
    SELECT lang, count(*) AS n_rows, sum(CASE WHEN prediction = lang THEN 1 ELSE 0 END)::BIGINT AS n_correct
    FROM predicted GROUP BY lang
    """,
)
def stream_accuracy_by_class(spark, sf_dir):
    """Update mode: each micro-batch writes changed groups; the newest of each is kept."""
    path = scratch_path(spark, "by-class")
    grouped = _scored_shapes(spark, sf_dir).groupBy("lang").agg(
        F.count("*").alias("n_rows"), F.sum("correct").alias("n_correct")
    )
    _finish(snapshot_stream(grouped, path, mode="update", trigger=_ALL))
    newest = F.max_by(F.struct("n_rows", "n_correct"), "batch_id").alias("state")
    return spark.read.parquet(path).groupBy("lang").agg(newest).select("lang", "state.*")


@query(
    "stream_batch_metrics",
    f"""
    WITH {GAUSSIAN_SQL}
    , confusion AS (SELECT doc_id % 4 AS batch, lang AS label, prediction, count(*) AS n FROM predicted GROUP BY ALL)
    , sides AS (
        SELECT batch, class, sum(support) AS support, sum(guessed) AS guessed, sum(hit) AS hit FROM (
            SELECT batch, label AS class, n AS support, 0 AS guessed,
                   CASE WHEN label = prediction THEN n ELSE 0 END AS hit FROM confusion
            UNION ALL SELECT batch, prediction, 0, n, 0 FROM confusion
        ) GROUP BY ALL
    )
    SELECT batch AS batch_id, sum(support)::BIGINT AS n_rows, round(sum(hit)::DOUBLE / sum(support), 6) AS accuracy,
           round(sum(support * (2.0::DOUBLE * hit / (support + guessed))) / sum(support), 6) AS weighted_f1
    FROM sides GROUP BY batch
    """,
)
def stream_batch_metrics(spark, sf_dir):
    """Metrics of four micro-batches: a quarter of the documents lands, the stream goes on where it stopped."""
    rows = stored_shape(spark, sf_dir)
    model = fit_shape(rows)
    folder, path = scratch_path(spark, "quarters"), scratch_path(spark, "batch-metrics")
    for quarter in range(4):
        publish(json_messages(rows.where(F.col("doc_id") % 4 == quarter), "doc_id"), folder)
        scored = with_correct(model.predict(parse_json_messages(message_replay(spark, folder), _SHAPE)), "lang")
        _finish(metric_stream(scored, path, "lang", trigger=_ALL))
    names = ["n_rows", "accuracy", "weighted_f1"]
    wide = spark.read.parquet(path).groupBy("batch_id").pivot("metric", names).agg(F.first("value"))
    return wide.select(
        F.col("batch_id").cast("bigint").alias("batch_id"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
        *(F.round(c, 6).alias(c) for c in names[1:]),
    )


@query("stream_batch_timing", "SELECT count(*) AS n_rows, true AS timed FROM events")
def stream_batch_timing(spark, sf_dir):
    """Rows and times of every micro-batch, from the table the listener writes."""
    events = table(spark, sf_dir, "events", *_EVENT.names)
    stream = parse_json_messages(_replay(spark, json_messages(events, "event_id"), "timed", 1), _EVENT)
    path = scratch_path(spark, "timing")
    listener = TimingListener(spark, path)
    spark.streams.addListener(listener)
    try:
        running = stream_sink(stream, "parquet", path=scratch_path(spark, "timed-events"), trigger=_ALL)
        _finish(running)
        listener.wait(running)
    finally:
        spark.streams.removeListener(listener)
    timing = batch_timing(spark, path, running.id)
    wide = timing.groupBy("batch_id").pivot("metric", ["count", "elapsed"]).agg(F.first("value"))
    return wide.agg(
        F.sum("count").cast("bigint").alias("n_rows"),
        F.bool_and((F.col("count") == 0) | (F.col("elapsed") > 0)).alias("timed"),
    )


@query(
    "stream_score",
    f"WITH {TERM_PREDICTION_SQL} SELECT doc_id, lang, prediction FROM predicted",
)
def stream_score(spark, sf_dir):
    """Text messages scored by a fitted pipeline, append mode into a file sink."""
    models = language_models(spark, sf_dir)
    messages = json_messages(documents(spark, sf_dir, "lang"), "doc_id")
    stream = parse_json_messages(_replay(spark, messages, "texts"), _TEXT)
    scored = score_stream(stream, *models)
    result = scored.select("doc_id", "lang", language_name(models).alias("prediction"))
    path = scratch_path(spark, "scored")
    _finish(stream_sink(result, "parquet", path=path, trigger=_ALL))
    return spark.read.schema(result.schema).parquet(path)


@query(
    "stream_raw_and_scored",
    f"""
    WITH {GAUSSIAN_SQL}
    SELECT doc_id, 'raw' AS output, lang AS value FROM documents
    UNION ALL SELECT doc_id, 'scored', prediction FROM predicted
    """,
)
def stream_raw_and_scored(spark, sf_dir):
    """Raw and scored rows written from one reading of the messages."""
    raw, scored = scratch_path(spark, "raw"), scratch_path(spark, "scored")
    _finish(
        raw_and_scored_stream(
            _scored_shapes(spark, sf_dir),
            raw,
            scored,
            ["doc_id", "lang"],
            ["doc_id", "prediction"],
            trigger=_ALL,
        )
    )
    left = spark.read.parquet(raw).select("doc_id", F.lit("raw").alias("output"), "lang")
    right = spark.read.parquet(scored).select("doc_id", F.lit("scored"), "prediction")
    return left.toDF("doc_id", "output", "value").unionAll(right)


_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
_EVENTS_SQL = "SELECT event_id, user_id, event_type, value FROM events"


def _drained(spark, parsed, name):
    path = scratch_path(spark, name)
    _finish(stream_sink(parsed, "parquet", path=path, trigger=_ALL))
    return spark.read.schema(parsed.schema).parquet(path)


@query("stream_json_parse", _EVENTS_SQL)
def stream_json_parse(spark, sf_dir):
    events = table(spark, sf_dir, "events", *_EVENT.names)
    stream = _replay(spark, json_messages(events, "event_id"), "json-events")
    return _drained(spark, parse_json_messages(stream, _EVENT), "parsed")


@query("stream_csv_parse", _EVENTS_SQL)
def stream_csv_parse(spark, sf_dir):
    events = table(spark, sf_dir, "events", *_EVENT.names)
    stream = _replay(spark, delimited_messages(events, "event_id"), "csv-events")
    return _drained(spark, parse_delimited_messages(stream, _EVENT), "parsed")


@query(
    "file_arrival_lines",
    """
    SELECT page_id // 200 AS bucket, (sum(strlen(html)) + count(*))::BIGINT AS n_bytes,
           (sum(length(html) - length(replace(html, chr(10), ''))) + count(*) + 1)::BIGINT AS n_lines
    FROM pages GROUP BY 1
    """,
)
def file_arrival_lines(spark, sf_dir):
    """Files landing in a folder, one per 200 pages; the lines of each counted as it arrives."""
    folder = scratch_path(spark, "landing")
    pages = table(spark, sf_dir, "pages", "page_id", "html").withColumn("bucket", F.expr("page_id div 200"))
    pages.repartition("bucket").select("bucket", "html").write.partitionBy("bucket").text(folder)
    path = scratch_path(spark, "file-lines")
    _finish(file_lines_stream(text_lines(spark, folder, "*.txt", 3), path, trigger=_ALL))
    bucket = F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket")
    return spark.read.parquet(path).select(bucket, F.col("length").alias("n_bytes"), "n_lines")
