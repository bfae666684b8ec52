"""Event-time streams: late rows, restarts, and equality with their batch form."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorestream.catalog import timed as catalog
from scorestream.sources.sinks import stream_sink
from scorestream.streaming import timed

START = datetime(2024, 1, 1)
SCHEMA = "id long, user long, ts timestamp, flag boolean"
ALL = {"availableNow": True}


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def at(minutes):
    return START + timedelta(minutes=minutes)


def run(result, path):
    query = stream_sink(result, "parquet", path=path, trigger=ALL)
    query.awaitTermination()
    return query


def test_a_row_behind_the_watermark_is_dropped_and_counted(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    hours = lambda events: timed.windowed(events, "ts", "10 minutes", "1 hour", aggregates=[F.count("*").alias("n")])
    land(spark, folder, [(1, 1, at(5), True), (2, 1, at(70), True)])
    run(hours(stream(spark, folder)), out)
    land(spark, folder, [(3, 1, at(50), True), (4, 1, at(62), True), (5, 1, at(200), True)])
    query = run(hours(stream(spark, folder)), out)
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    rows = {r["window_start"]: r["n"] for r in spark.read.parquet(out).collect()}
    assert rows == {at(0): 1, at(60): 2} and dropped == 1


@pytest.fixture(scope="module")
def events():
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None]), at(i // 2 * 3 + rng.choice([0, 1])), rng.random() < 0.4) for i in range(240)]
    return rows


FORMS = {
    "tumbling": lambda e: timed.windowed(e, "ts", "3 hours", "1 hour", by=["user"], aggregates=[F.count("*").alias("n")]),
    "sliding": lambda e: timed.windowed(e, "ts", "3 hours", "2 hours", "30 minutes", aggregates=[F.count("*").alias("n")]),
    "sessions": lambda e: timed.sessions(e, "user", "ts", "3 hours", "12 minutes", [F.count("*").alias("n")]),
    "once": lambda e: timed.first_sightings(e, ["id"], "ts", "3 hours").select("id", "user"),
    "alarms": lambda e: timed.rolling_alarms(e, "user", "ts", "id", "flag", "3 hours", 5, 3),
    "followed": lambda e: timed.followed_by(
        e.where("flag").select("id", "user", "ts"),
        e.where("not flag").select(F.col("id").alias("next"), "user", F.col("ts").alias("after")), "user", "ts", "after", "3 hours", "9 minutes",
    ),
}


@pytest.mark.parametrize("name", FORMS)
def test_a_shuffled_stream_that_is_stopped_between_files_equals_the_batch(spark, events, tmp_path, name):
    """Files overlap in time; the second half lands after the query was stopped once."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(4)
    parts = [events[i : i + 60] for i in range(0, 240, 60)]
    for half in (parts[:2], parts[2:] + [[(-1, 9, at(100_000), False), (-1, 9, at(100_000), True)]]):
        for part in half:
            part = part * 2 if name == "once" else list(part)
            rng.shuffle(part)
            land(spark, folder, part)
        run(FORMS[name](stream(spark, folder)), out)
    end = "user = 9" if "user" in spark.read.parquet(out).columns else "false"
    found = sorted(map(repr, spark.read.parquet(out).where(f"not coalesce({end}, false)").collect()))
    batch = FORMS[name](spark.createDataFrame(events, SCHEMA))
    assert found == sorted(map(repr, batch.collect())) and found


def test_alarms_equal_a_plain_walk():
    rng = random.Random(5)
    rows = [(rng.randrange(200), i, rng.random() < 0.5) for i in range(150)]
    rolling, state, got = timed.Rolling(6, 4), None, []
    arrived, waiting = [], sorted(rows)
    while waiting:
        part, waiting = waiting[:20], waiting[20:]
        rng.shuffle(part)
        arrived += part
        state, changes, due = rolling.advance(state, part, part and min(waiting, default=(999,))[0] - 1)
        got += changes
    flags, raised, expected = [], False, []
    for t, i, f in sorted(rows):
        flags = (flags + [f])[-6:]
        if (sum(flags) >= 4) != raised:
            raised = not raised
            expected.append((t, i, sum(flags), raised))
    assert got == expected and expected and due is None


def test_keys_of_a_group_go_forward_together_as_each_does_alone():
    """Ties, rows that come twice, and what arrives before its turn, in a few calls for all keys."""
    rng = random.Random(6)
    rows = [(rng.choice("abcdefg"), rng.randrange(60), rng.randrange(9), rng.random() < 0.5) for _ in range(400)]
    rows += rows[:20]
    names = ["key", "micros", "id", "flag"]
    rolling, state, got = timed.Rolling(5, 2), None, []
    for low, high in ((0, 20), (20, 40), (40, 60)):
        part = [r for r in rows if low <= r[1] < high]
        rng.shuffle(part)
        for half in (part[::2], part[1::2]):
            state, changes, due = rolling.advance_keys(state, [pd.DataFrame(half, columns=names)], low - 1)
            got += map(tuple, changes.to_numpy().tolist())
    state, changes, due = rolling.advance_keys(state, [], 60)
    got += map(tuple, changes.to_numpy().tolist())
    expected = []
    for key in "abcdefg":
        flags, raised = [], False
        for _, t, i, f in sorted(r for r in rows if r[0] == key):
            flags = (flags + [f])[-5:]
            if (sum(flags) >= 2) != raised:
                raised = not raised
                expected.append((key, t, i, sum(flags), raised))
    assert sorted(got) == sorted(expected) and expected and due is None


def test_alarms_keep_a_state_per_group_of_keys_not_per_key(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, folder, [(i, i // 2, at(i % 2), True) for i in range(2000)])
    land(spark, folder, [(-1, -1, at(100_000), False)])
    query = run(FORMS["alarms"](stream(spark, folder)), out)
    kept = max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"])
    assert 0 < kept <= 256


def test_micro_batches_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    """As many files as a table of millions of rows gives; the rows are those of the batch."""
    rows = [(i, at(i * 7), i % 5, "view", 1.0, "{}") for i in range(3000)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    started = []
    monkeypatch.setattr(catalog, "_ROWS_PER_FILE", 25)
    monkeypatch.setattr(catalog, "stream_sink", lambda *a, **k: started.append(stream_sink(*a, **k)) or started[-1])
    found = catalog.stream_tumbling_windows(spark, str(tmp_path))
    assert found.agg(F.sum("n_rows")).first()[0] == 3000
    read = [p for p in started[0].recentProgress if p["numInputRows"]]
    assert 3 < len(read) <= 13
