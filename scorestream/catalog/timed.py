"""Event-time streams: events land in slices of time, shuffled inside, and the state follows the watermark."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from scorestream.catalog.registry import query, table
from scorestream.sources.sinks import json_messages, publish, stream_sink
from scorestream.sources.streams import files_per_trigger, message_replay
from scorestream.streaming.messages import parse_json_messages
from scorestream.streaming.timed import first_sightings, followed_by, rolling_alarms, sessions, windowed
from scorestream.workspace import scratch_path

#: Slices of time that land one after the other; rows inside one are in no order.
_SLICES = 3
_ROWS_PER_FILE = 50_000
_FILES_PER_TRIGGER = 4
#: With more files than give so many micro-batches, a micro-batch takes more files.
_BATCHES = 12
_MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("micros", T.LongType()),
    ]
)


def _landed(spark, sf_dir, twice=False):
    """A folder of event messages in slices of time, closed by a row far in the future, and the length of a slice."""
    events = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "ts")
    events = events.withColumn("micros", F.unix_micros(F.col("ts").cast("timestamp_ntz").cast("timestamp"))).drop("ts")
    first, last, n_rows = events.agg(F.min("micros"), F.max("micros"), F.count("micros")).first()
    step = (last - first) // _SLICES + 1
    writers = max(2, -(-n_rows // (_SLICES * _ROWS_PER_FILE)))
    folder = scratch_path(spark, "timed-events")
    for k in range(_SLICES):
        part = events.where(F.col("micros").between(first + k * step, first + (k + 1) * step - 1))
        part = part.repartition(writers).sortWithinPartitions(F.xxhash64("event_id"))
        messages = json_messages(part.unionAll(part) if twice else part, "event_id")
        publish(messages, folder, options={"maxRecordsPerFile": _ROWS_PER_FILE})
    far = [(-1, -1, kind, 0.0, last + 1000 * 86_400_000_000) for kind in ("view", "purchase")]
    publish(json_messages(spark.createDataFrame(far, _MESSAGE), "event_id"), folder)
    return folder, f"{step // 1_000_000 + 1} seconds"


def _events(spark, folder):
    files = files_per_trigger(spark, folder, _FILES_PER_TRIGGER, _BATCHES)
    parsed = parse_json_messages(message_replay(spark, folder, files), _MESSAGE)
    return parsed.withColumn("ts", F.timestamp_micros("micros")).drop("micros")


def _finished(spark, result, name):
    """All rows that the stream has given once its input has ended, times in microseconds."""
    path = scratch_path(spark, name)
    stream_sink(result, "parquet", path=path, trigger={"availableNow": True}).awaitTermination()
    rows = spark.read.schema(result.schema).parquet(path)
    times = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
    return rows.withColumns({name: F.unix_micros(name) for name in times})


def _totals():
    total = F.sum(F.col("value").cast("decimal(20,4)")).cast("double")
    return [F.count("*").alias("n_rows"), F.round(total, 4).alias("total")]


_TOTALS_SQL = "count(*) AS n_rows, round(sum(value::DECIMAL(20,4)), 4)::DOUBLE AS total"


@query(
    "stream_tumbling_windows",
    f"""
    SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_start,
           epoch_us(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR) AS window_end,
           event_type, {_TOTALS_SQL}
    FROM events GROUP BY ALL
    """,
)
def stream_tumbling_windows(spark, sf_dir):
    """Events per hour and type, each window written once the watermark has passed its end."""
    folder, delay = _landed(spark, sf_dir)
    result = windowed(_events(spark, folder), "ts", delay, "1 hour", by=["event_type"], aggregates=_totals())
    return _finished(spark, result, "tumbling").where("event_type is not null")


@query(
    "stream_sliding_windows",
    f"""
    WITH spans AS (
        SELECT time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(6 * k AS INTEGER)) AS window_start, ts, value
        FROM events, range(4) AS steps(k)
    )
    SELECT epoch_us(window_start) AS window_start, epoch_us(window_start + INTERVAL 1 DAY) AS window_end, {_TOTALS_SQL}
    FROM spans WHERE ts < spans.window_start + INTERVAL 1 DAY GROUP BY ALL
    """,
)
def stream_sliding_windows(spark, sf_dir):
    """A day of events, every six hours."""
    folder, delay = _landed(spark, sf_dir)
    return _finished(
        spark, windowed(_events(spark, folder), "ts", delay, "1 day", "6 hours", aggregates=_totals()), "sliding"
    )


@query(
    "stream_sessions",
    f"""
    WITH gaps AS (
        SELECT user_id, ts, value,
               coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 2 HOUR, true) AS fresh
        FROM events
    ), islands AS (
        SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM gaps
    )
    SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts) + INTERVAL 2 HOUR) AS session_end, {_TOTALS_SQL}
    FROM islands GROUP BY user_id, island
    """,
)
def stream_sessions(spark, sf_dir):
    """A user's events that follow each other within two hours."""
    folder, delay = _landed(spark, sf_dir)
    result = sessions(_events(spark, folder), "user_id", "ts", delay, "2 hours", _totals())
    return _finished(spark, result, "sessions").where("user_id >= 0")


@query("stream_first_sightings", "SELECT event_id, user_id, event_type, value FROM events")
def stream_first_sightings(spark, sf_dir):
    """Every message is delivered twice; one of each is kept."""
    folder, delay = _landed(spark, sf_dir, twice=True)
    once = first_sightings(_events(spark, folder), ["event_id"], "ts", delay).drop("ts")
    return _finished(spark, once, "once").where("event_id >= 0")


@query(
    "stream_followed_by",
    """
    SELECT v.event_id, v.user_id, p.event_id AS bought_id
    FROM events v LEFT JOIN events p
      ON v.user_id = p.user_id AND p.event_type = 'purchase' AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 12 HOUR
    WHERE v.event_type = 'view'
    """,
)
def stream_followed_by(spark, sf_dir):
    """Views with the purchases of the same user in the next twelve hours; views without any once these have passed."""
    folder, delay = _landed(spark, sf_dir)
    views = _events(spark, folder).where("event_type = 'view'").select("event_id", "user_id", "ts")
    bought = _events(spark, folder).where("event_type = 'purchase'")
    bought = bought.select("user_id", F.col("event_id").alias("bought_id"), F.col("ts").alias("bought_at"))
    result = followed_by(views, bought, "user_id", "ts", "bought_at", delay, "12 hours").drop("ts", "bought_at")
    return _finished(spark, result, "followed").where("user_id >= 0")


@query(
    "stream_rolling_alarms",
    """
    WITH counted AS (
        SELECT user_id, ts, event_id, sum((event_type = 'error')::INTEGER) OVER w AS n
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING)
    ), judged AS (
        SELECT *, n >= 2 AS raised, coalesce(lag(n >= 2) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS was
        FROM counted
    )
    SELECT user_id, epoch_us(ts) AS ts, event_id, n::BIGINT AS n_flagged, raised FROM judged WHERE raised <> was
    """,
)
def stream_rolling_alarms(spark, sf_dir):
    """Where two of a user's last five events are errors, and where they no longer are."""
    folder, delay = _landed(spark, sf_dir)
    flagged = _events(spark, folder).withColumn("failed", F.col("event_type") == "error")
    result = rolling_alarms(flagged, "user_id", "ts", "event_id", "failed", delay, 5, 2)
    return _finished(spark, result, "alarms")
