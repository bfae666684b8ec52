import pytest
from pyspark.sql import functions as F, types as T

from scorestream.catalog import streams as catalog
from scorestream.operators import metrics
from scorestream.sources import sinks, streams
from scorestream.streaming import arrivals, messages, monitor, scoring

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("prediction", T.StringType()),
    ]
)
ALL = {"availableNow": True}


@pytest.fixture
def scored(spark):
    return spark.range(90).select(
        "id",
        F.concat(F.lit("c"), F.col("id") % 3).alias("label"),
        F.concat(F.lit("c"), (F.col("id") * F.col("id")) % 3).alias("prediction"),
    )


@pytest.fixture
def replay(spark, scored, tmp_path):
    path = str(tmp_path / "topic")
    sinks.publish(sinks.json_messages(scored.coalesce(1), "id"), path, options={"maxRecordsPerFile": 20})
    stream = streams.message_replay(spark, path, files_per_trigger=1)
    assert stream.isStreaming
    return messages.parse_json_messages(stream, SCHEMA)


def test_append_sink_equals_the_batch(spark, scored, replay, tmp_path):
    path = str(tmp_path / "out")
    query = sinks.stream_sink(replay, "parquet", path=path, trigger=ALL)
    query.awaitTermination()
    assert sorted(spark.read.parquet(path).collect()) == sorted(scored.collect())
    assert len(query.recentProgress) >= 5


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_running_accuracy_equals_the_batch(spark, scored, replay, tmp_path, mode):
    path = str(tmp_path / "acc")
    accuracy = scoring.running_accuracy(scoring.with_correct(replay, "label"))
    query = scoring.snapshot_stream(accuracy, path, mode=mode, name=f"acc_{mode}", trigger=ALL)
    query.awaitTermination()
    assert query.name == f"acc_{mode}"
    last = scoring.last_snapshot(spark, path).collect()
    batch = scoring.running_accuracy(scoring.with_correct(scored, "label")).collect()
    assert [tuple(r) for r in last] == [tuple(r) for r in batch]
    assert spark.read.parquet(path).select("batch_id").distinct().count() >= 5


def test_append_mode_is_refused_for_the_running_accuracy(replay, tmp_path):
    accuracy = scoring.running_accuracy(scoring.with_correct(replay, "label"))
    with pytest.raises(Exception):
        scoring.snapshot_stream(accuracy, str(tmp_path / "x"), mode="append", trigger=ALL)


def test_metrics_of_each_micro_batch(spark, scored, replay, tmp_path):
    path = str(tmp_path / "metrics")
    query = scoring.metric_stream(replay, path, "label", scale=100.0, trigger=ALL)
    query.awaitTermination()
    rows = spark.read.parquet(path)
    counts = rows.where("metric = 'n_rows'").collect()
    assert len(counts) == 5 and sum(r.value for r in counts) == 90
    right = scored.where("label = prediction").count()
    weighted = rows.groupBy("batch_id").pivot("metric", ["n_rows", "accuracy"]).agg(F.first("value"))
    total = weighted.agg(F.sum(F.col("n_rows") * F.col("accuracy") / 100)).first()[0]
    assert round(total) == right


def test_a_restarted_stream_goes_on_and_another_writes_beside_it(spark, scored, tmp_path):
    folder, path = str(tmp_path / "topic"), str(tmp_path / "metrics")

    def run(**how):
        stream = spark.readStream.schema(scored.schema).parquet(folder)
        scoring.metric_stream(stream, path, "label", trigger=ALL, **how).awaitTermination()
        accuracy = scoring.running_accuracy(scoring.with_correct(stream, "label"))
        out = str(tmp_path / "running")
        scoring.snapshot_stream(accuracy, out, trigger=ALL).awaitTermination()
        return spark.read.parquet(path), scoring.last_snapshot(spark, out).first()

    scored.coalesce(1).write.parquet(folder)
    first, running = run()
    assert (first.count(), running.n_rows) == (4, 90)
    old = sorted(map(tuple, first.select("batch_id", "metric", "value").collect()))
    scored.limit(10).coalesce(1).write.mode("append").parquet(folder)
    second, running = run()
    rows = sorted(map(tuple, second.select("batch_id", "metric", "value").collect()))
    assert [r for r in rows if r[0] == 0] == old
    assert (len(rows), running.n_rows) == (8, 100)
    third, _ = run(checkpoint=str(tmp_path / "other"))
    assert third.count() == 12 and third.select("stream").distinct().count() == 2
    kept = third.join(second.select("stream").distinct(), "stream", "left_semi")
    assert sorted(map(tuple, kept.select("batch_id", "metric", "value").collect())) == rows


def test_a_stream_without_a_place_for_its_state_is_refused(replay):
    with pytest.raises(ValueError):
        sinks.stream_sink(replay, "kafka")


def test_a_replayed_batch_replaces_itself(spark, scored, tmp_path):
    path = str(tmp_path / "again")
    for state in ("a", "a", "b"):
        sinks.write_batch(metrics.batch_metrics(scored, 4, "label").drop("batch_id"), path, 4, state)
    assert spark.read.parquet(path).count() == 8


def test_raw_and_scored_outputs(spark, scored, replay, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "scored")
    query = scoring.raw_and_scored_stream(
        replay, raw, out, ["id", "label"], ["id", "prediction"], trigger=ALL
    )
    query.awaitTermination()
    assert spark.read.parquet(raw).count() == spark.read.parquet(out).count() == 90


def test_memory_and_console_sinks(spark, replay):
    for fmt in ("memory", "console"):
        query = sinks.stream_sink(
            replay, fmt, name=f"seen_{fmt}", trigger=ALL, options={"truncate": "false", "numRows": "1"}
        )
        query.awaitTermination()
    assert spark.table("seen_memory").count() == 90


def test_timing_of_every_batch_by_query(spark, replay, tmp_path):
    path = str(tmp_path / "timing")
    listener = monitor.TimingListener(spark, path)
    spark.streams.addListener(listener)
    try:
        queries = [sinks.stream_sink(replay, "parquet", path=str(tmp_path / o), trigger=ALL) for o in "ab"]
        for query in queries:
            query.awaitTermination()
            assert listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    for query in queries:
        timing = monitor.batch_timing(spark, path, query.id)
        assert {r.metric for r in timing.collect()} == {"count", "elapsed", "latency", "rows_per_second"}
        assert timing.where("metric = 'count'").agg(F.sum("value")).first()[0] == 90
    assert monitor.batch_timing(spark, path).where("metric = 'count'").agg(F.sum("value")).first()[0] == 180


def test_delimited_and_broken_messages(spark):
    df = spark.createDataFrame(
        [(bytearray(b"1,a,b"),), (bytearray(b"2,a"),), (bytearray(b"x,y,z"),)], "value binary"
    )
    rows = messages.parse_delimited_messages(df, SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(1, "a", "b"), (2, "a", None), (None, "y", "z")]
    texts = [b'{"id": 1, "label": "a"}', b"{broken", b'{"id": "no"}', None, b"", b"  ", b"null", b"{}"]
    rows = [(str(i), None if t is None else bytearray(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "key string, value binary")
    good, bad = messages.split_json_messages(df, SCHEMA, keep=["key"])
    assert sorted(map(tuple, good.collect())) == [("0", 1, "a", None), ("7", None, None, None)]
    assert sorted((r.key, r.message) for r in bad.collect()) == [
        ("1", "{broken"), ("2", '{"id": "no"}'), ("3", None), ("4", ""), ("5", "  "), ("6", "null")
    ]


@pytest.mark.parametrize("delimiter", [",", "|", "\t"])
def test_delimited_items_survive_delimiters_quotes_and_breaks(spark, delimiter):
    texts = ["x, y", 'say "hi"', "a\nb", "a|b\tc", "", None, "  padded ", "\\", "#", '"', ",,,"]
    rows = [(i, t, "end") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, label string, other string")
    sent = sinks.delimited_messages(df, "id", delimiter)
    parsed = messages.parse_delimited_messages(sent, df.schema, delimiter=delimiter)
    assert sorted(map(tuple, parsed.collect())) == rows


def test_files_are_counted_as_they_arrive(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    contents = {"a.txt": "x\n" * 100, "b.txt": "one line", "c.txt": "", "d.txt": "\n", "e.txt": "ü\r\n\nz"}
    for name, content in contents.items():
        (folder / name).write_text(content)
    (folder / "skip.log").write_text("a\nb")
    stream = streams.text_lines(spark, str(folder), "*.txt", files_per_trigger=1)
    out = str(tmp_path / "lines")
    arrivals.file_lines_stream(stream, out, trigger=ALL).awaitTermination()
    del contents["c.txt"]  # the engine's file sources pass over empty files
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.n_lines) for r in spark.read.parquet(out).collect()}
    assert got == {"a.txt": (200, 101), "b.txt": (8, 1), "d.txt": (1, 2), "e.txt": (6, 3)}
    assert got.keys() == contents.keys()
    whole = str(tmp_path / "whole")
    sinks.stream_sink(streams.arriving_files(spark, str(folder), "*.txt"), "parquet", path=whole, trigger=ALL).awaitTermination()
    assert spark.read.parquet(whole).agg(F.sum("length")).first()[0] == sum(len(c.encode()) for c in contents.values())
    files = spark.read.format("binaryFile").load(str(folder))
    paths = arrivals.event_paths(arrivals.arrival_events(files))
    assert sorted(paths.collect()) == sorted(files.select("path").collect())


def test_micro_batches_of_a_replay_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    """A folder of 100 files, one a micro-batch while these are few."""
    rows = [(i, i % 7, "view", 1.0) for i in range(500)]
    schema = "event_id long, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    started = []
    monkeypatch.setattr(catalog, "_ROWS_PER_FILE", 5)
    monkeypatch.setattr(catalog, "stream_sink", lambda *a, **k: started.append(sinks.stream_sink(*a, **k)) or started[-1])
    found = catalog.stream_batch_timing(spark, str(tmp_path)).first()
    assert (found["n_rows"], found["timed"]) == (500, True)
    assert 15 <= len([p for p in started[0].recentProgress if p["numInputRows"]]) <= 24
