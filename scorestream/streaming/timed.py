"""Event time on streams: windows, sessions, interval joins, first sightings, ordered state.

State is bounded by the watermark: a row may come ``delay`` after a later one,
what is older is dropped and counted by the engine, and what can get no more
rows leaves the state.  All functions take batches as well, where the watermark
has no effect and every result is final.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(
    events: DataFrame,
    time: str,
    delay: str,
    length: str,
    slide: str | None = None,
    by: Sequence[str] = (),
    aggregates: Sequence[Column] = (),
) -> DataFrame:
    """(window_start, window_end, by, aggregates) of tumbling windows, or sliding ones if ``slide`` is given.

    Partial aggregates are combined before the shuffle, so a group that holds a
    third of the rows is one row per task.
    """
    span = F.window(time, length, slide) if slide else F.window(time, length)
    grouped = events.withWatermark(time, delay).groupBy(span.alias("_window"), *by).agg(*aggregates)
    return grouped.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *grouped.columns[1:]
    )


def sessions(
    events: DataFrame, key: str, time: str, delay: str, gap: str, aggregates: Sequence[Column] = ()
) -> DataFrame:
    """(key, session_start, session_end, aggregates): rows of a key that follow each other within ``gap``.

    The end is the last row's time plus the gap.  Two rows exactly one gap apart
    are of two sessions.
    """
    grouped = events.withWatermark(time, delay).groupBy(key, F.session_window(time, gap).alias("_session")).agg(*aggregates)
    return grouped.select(
        key,
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        *grouped.columns[2:],
    )


def first_sightings(events: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One row per key of those that come within the watermark of each other; a key leaves the state after that."""
    marked = events.withWatermark(time, delay)
    return marked.dropDuplicatesWithinWatermark(list(keys)) if events.isStreaming else events.dropDuplicates(list(keys))


def followed_by(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, delay: str, within: str
) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` of the same key at most ``within`` later.

    A left row without any is returned with nulls once none can come any more.
    Columns of ``right`` other than the key must have names of their own; its key
    is dropped.  Rows with a null key match nothing.
    """
    ahead = left.withWatermark(left_time, delay)
    after = right.withColumnRenamed(key, "_key").withWatermark(right_time, delay)
    close = F.col(right_time).between(F.col(left_time), F.col(left_time) + F.expr(f"INTERVAL {within}"))
    return ahead.join(after, (ahead[key] == after["_key"]) & close, "left_outer").drop("_key")


class Rolling:
    """The last ``size`` rows of every key, and rows that still wait for earlier ones.

    Rows are (key, time in microseconds, id, flag).  The state is one Arrow table
    of all of them, so many keys are taken forward at once, column by column.
    """

    schema = "rows binary"

    def __init__(self, size: int, limit: int):
        self.size = size
        self.limit = limit

    def advance(self, state: tuple | None, rows: list[tuple], until: int | None) -> tuple[tuple, list[tuple], int | None]:
        """``advance_keys`` for the rows (time, id, flag) of one key."""
        frame = pd.DataFrame([(0, t, i, bool(f)) for t, i, f in rows], columns=["key", "micros", "id", "flag"])
        after, changes, due = self.advance_keys(state, [frame], until)
        names = ("micros", "id", "n_flagged", "raised")
        return after, list(zip(*(changes[c].tolist() for c in names))), due

    def advance_keys(
        self, state: tuple | None, frames: Iterable[pd.DataFrame], until: int | None
    ) -> tuple[tuple | None, pd.DataFrame, int | None]:
        """The new state, (key, micros, id, n_flagged, raised) where a key's alarm goes on or off, and the first time waiting.

        Rows up to ``until``, all if it is None, are taken key by key in the order
        of time and id.  Whether an alarm is on follows from the last ``size`` rows
        of its key, which stay in the state.
        """
        known = [_unpacked(state[0])] if state else []
        known += [[*(frame[c].to_numpy() for c in _ROW), np.zeros(len(frame), dtype=bool)] for frame in frames if len(frame)]
        if not known:
            return state, _NO_CHANGES, None
        rows = [np.concatenate(column) for column in zip(*known)] if len(known) > 1 else known[0]
        waits = ~rows[4] & (rows[1] > until) if until is not None else np.zeros(len(rows[0]), dtype=bool)
        waiting, rows = [c[waits] for c in rows], [c[~waits] for c in rows]
        keys, micros, ids, flags, past = rows
        codes, at = pd.factorize(keys)[0], np.arange(len(keys))
        # Rows taken before keep their order and come first.
        order = np.lexsort((flags, ids, micros, np.where(past, at, 0), ~past, codes))
        keys, micros, ids, flags, past, codes = (c[order] for c in (*rows, codes))
        first = np.diff(codes, prepend=-1) != 0
        start = np.maximum.accumulate(np.where(first, at, 0))
        sums = np.concatenate([[0], np.cumsum(flags, dtype="int64")])
        flagged = sums[1:] - sums[np.maximum(start, at - self.size + 1)]
        raised = flagged >= self.limit
        was = np.concatenate([[False], raised[:-1]])[: len(raised)] & ~first
        turns = ~past & (raised != was)
        found = (keys[turns], micros[turns], ids[turns], flagged[turns], raised[turns])
        ends = np.append(first[1:], True)[: len(first)]
        end = np.minimum.accumulate(np.where(ends, at, len(at))[::-1])[::-1]
        kept = at > end - self.size
        past = np.ones(int(kept.sum()), dtype=bool)
        after = [np.concatenate(c) for c in zip([keys[kept], micros[kept], ids[kept], flags[kept], past], waiting)]
        changes = pd.DataFrame(dict(zip(_NO_CHANGES, found))) if turns.any() else _NO_CHANGES
        return (_packed(after),), changes, int(waiting[1].min()) if len(waiting[1]) else None


_ROW = ("key", "micros", "id", "flag")
_NO_CHANGES = pd.DataFrame({"key": [], "micros": [], "id": [], "n_flagged": [], "raised": []})


def _packed(rows: list[np.ndarray]) -> bytes:
    batch, sink = pa.RecordBatch.from_arrays([pa.array(c) for c in rows], [*_ROW, "past"]), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> list[np.ndarray]:
    table = pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all()
    return [column.to_numpy() for column in table.columns]


#: Groups of keys of ``rolling_alarms``; a call to Python takes all rows of a group in a micro-batch.
_KEY_GROUPS = 256


def rolling_alarms(
    events: DataFrame, key: str, time: str, row_id: str, flag: str, delay: str, size: int, limit: int
) -> DataFrame:
    """(key, time, id, n_flagged, raised) where the flagged among a key's last ``size`` rows reach ``limit`` or fall below.

    Rows are taken in event time, ties by id, whatever their order of arrival: a
    row waits in the state until the watermark has passed it, when a timer calls
    for it.  State per key: ``size`` rows and the rows of one ``delay``.  Keys are
    dealt by their hash into groups that share a state, so a micro-batch costs a
    call per group and not per key.  Rows with a null key, time, id or flag take
    no part.
    """
    rolling = Rolling(size, limit)
    kind = events.schema[key].dataType.simpleString()
    out = f"key {kind}, micros long, id long, n_flagged long, raised boolean"

    def step(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        after, changes, due = rolling.advance_keys(state.get if state.exists else None, frames, passed * 1000)
        if after is not None:
            state.update(after)
        if due is not None:
            state.setTimeoutTimestamp(max(due // 1000 + 1, passed + 1))
        if len(changes):
            yield changes

    def whole(name: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return rolling.advance_keys(None, [frame], None)[1]

    rows = events.dropna(subset=[key, time, row_id, flag])
    if events.isStreaming:
        rows = rows.withWatermark(time, delay)
    rows = rows.select(
        F.col(key).alias("key"), F.col(time).alias("time"), F.unix_micros(time).alias("micros"),
        F.pmod(F.xxhash64(key), F.lit(_KEY_GROUPS)).alias("keys"), F.col(row_id).cast("long").alias("id"), F.col(flag).cast("boolean").alias("flag"),
    )
    if events.isStreaming:
        found = rows.groupBy("keys").applyInPandasWithState(
            step, out, Rolling.schema, "append", GroupStateTimeout.EventTimeTimeout
        )
    else:
        found = rows.groupBy("key").applyInPandas(whole, out)
    return found.select(
        F.col("key").alias(key), F.timestamp_micros("micros").alias(time), F.col("id").alias(row_id), "n_flagged", "raised"
    )
