"""Sessions with state in Spark's state store (X02, X04): the bounded-state
alternative to the tables of ``ingest``.

``stateful_sessions`` keeps, for each user, the events of sessions that can still
grow.  A timer closes a session once the watermark has passed its end by the
gap; its row is emitted and its events leave the state, so state is bounded by
the users and events of the watermark's horizon, not by history.  It lives in
the RocksDB store, and batches checkpoint its changes.

Users are held by the bucket (a hash of the user), with one state row and one
timer a bucket: a key costs a Python task about ten milliseconds a batch, whatever
the number of its events, so a key a user would cost more than all the work on
its events.  Events travel and are held packed, as rows of 64-bit integers.

Nothing is lost in silence.  Rows behind the watermark are emitted as ``late``
(a side table for the complete way of ``ingest``), further deliveries of an
event that is still held as ``duplicate``, whatever day they name, and rows
without a user, a time or an id as ``invalid``: rows in = events of sessions +
late + duplicate + invalid + events still held."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mercato.functions.expressions import epoch_micros
from mercato.streaming.ingest import read_landed_events, run_to_files

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"

OUTPUT = ("kind string, customer_id long, first_us long, last_us long, events long, product_views long, add_to_cart long,"
          " checkout_started long, purchase_completed long, event_id long")
KINDS = ("view", "click", "signup", "purchase")
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]
STATE = "events binary, timer long"

#: Buckets of users; part of the state's key, so fixed for the life of a checkpoint.
BUCKETS = 1024
#: Events that a task packs at a time, and events of a packed row at most.
PACK, PACKED = 100_000, 1024
PACKED_ROWS = "bucket int, events binary"
#: Columns of packed events; ``kind`` is the place in KINDS, from 1 (0: another type).
USER, ID, US, KIND = range(4)


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int64).reshape(-1, 4)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, customer_id, event_id, us, kind) -> packed rows of one bucket
    each; events of a bucket keep their order."""
    def packed(held: list) -> pa.RecordBatch:
        bucket, events = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(bucket, kind="stable")
        bucket, events = bucket[order], events[order]
        new = np.arange(len(bucket)) % PACKED == 0
        new[1:] |= bucket[1:] != bucket[:-1]
        cuts = np.flatnonzero(new)
        rows = [events[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(bucket)])]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts], pa.int32()), pa.array(rows, pa.binary())], ["bucket", "events"])

    held, n = [], 0
    for batch in batches:
        bucket, *fields = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        held.append((bucket.astype(np.int16), np.column_stack(fields)))
        n += batch.num_rows
        if n >= PACK:
            yield packed(held)
            held, n = [], 0
    if n:
        yield packed(held)


def _again(events: np.ndarray) -> np.ndarray:
    """Which events are further deliveries of one before them (same user and id)."""
    order = np.lexsort((events[:, ID], events[:, USER]))
    user, i = events[order, USER], events[order, ID]
    again = np.zeros(len(events), bool)
    again[order[1:]] = (user[1:] == user[:-1]) & (i[1:] == i[:-1])
    return again


class SessionProcessor(StatefulProcessor):
    """State of one bucket: the packed events of open sessions, and its timer."""

    def __init__(self, gap_us: int):
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", STATE)

    def _side(self, kind: str, events: np.ndarray) -> Iterator[pd.DataFrame]:
        if len(events):
            us = events[:, US]
            yield pd.DataFrame(dict(zip(COLUMNS, (kind, events[:, USER], us, us, 1, 0, 0, 0, 0, events[:, ID]))))

    def _close(self, events: np.ndarray, timer: int | None, watermark_us: int) -> Iterator[pd.DataFrame]:
        """Emit the sessions that end a gap before the watermark; keep the rest."""
        events = events[np.lexsort((events[:, US], events[:, USER]))]
        user, us = events[:, USER], events[:, US]
        new = np.ones(len(events), bool)
        new[1:] = (user[1:] != user[:-1]) | (us[1:] - us[:-1] >= self.gap)
        first = np.flatnonzero(new)
        n = np.diff(first, append=len(events))
        ends = us[first + n - 1] + self.gap
        done = ends <= watermark_us
        if timer is not None:
            self.handle.deleteTimer(timer)
        if done.all():
            self.held.clear()
        else:
            # fires once the watermark, in whole milliseconds, has passed the earliest end of an open session
            timer = -(-int(ends[~done].min()) // 1000) - 1
            self.handle.registerTimer(timer)
            self.held.update((events[np.repeat(~done, n)].tobytes(), timer))
        if done.any():
            counts = [np.add.reduceat((events[:, KIND] == k).astype(np.int64), first)[done] for k in range(1, len(KINDS) + 1)]
            none = pd.array([None] * int(done.sum()), "Int64")
            yield pd.DataFrame(dict(zip(COLUMNS, ("session", user[first][done], us[first][done], ends[done] - self.gap, n[done], *counts, none))))

    def _state(self) -> tuple[np.ndarray, int | None]:
        held = self.held.get()
        return (_unpack(held[0]), held[1]) if held else (_unpack(b""), None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held, timer = self._state()
        fresh = _unpack(b"".join(b for frame in rows for b in frame["events"]))
        late = fresh[:, US] < mark
        events = np.concatenate([held, fresh[~late]])
        again = _again(events)
        yield from self._side("late", fresh[late])
        yield from self._side("duplicate", events[again])
        yield from self._close(events[~again], timer, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._close(*self._state(), timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def stateful_sessions(spark: SparkSession, landing: str, out: str, checkpoint: str, gap_seconds: int = 6 * 3600,
                      delay: str = "1 day", max_files_per_trigger: int | None = 1, closing: bool = True) -> DataFrame:
    """Closed sessions and side rows (see the module), by ``kind``, of the landed
    events; ``delay`` is how far the watermark stays behind the latest event.

    A micro-batch's rows are never late for one another, those of the next one
    are: files that hold the same days belong into one batch
    (``max_files_per_trigger`` None: all that has landed).  The last batch closes
    what the watermark has passed by then; with ``closing`` false (more is to
    land) that is left to the next batch with rows."""
    s = read_landed_events(spark, landing, max_files_per_trigger=max_files_per_trigger).select("event_id", "ts", "user_id", "event_type", "event_time")
    valid = "event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL"
    kind = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.col("event_type")), F.lit(0).cast("long"))
    # the watermarked column itself goes: Spark would drop rows behind it here
    good = s.where(valid).withWatermark("event_time", delay).select(
        F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int").alias("bucket"), F.col("user_id").alias("customer_id"),
        "event_id", epoch_micros("ts").alias("us"), kind.alias("kind"))
    sessions = good.mapInArrow(_pack, PACKED_ROWS).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=SessionProcessor(int(gap_seconds) * 1_000_000), outputStructType=OUTPUT, outputMode="append", timeMode="EventTime")
    # each drain opens its own stores: those of drains before would stay on the executors' disks for a while
    conf = {PROVIDER: ROCKSDB, NO_DATA: str(closing).lower(), UNLOAD: "true"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run_to_files(sessions, out, checkpoint)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
