"""Streaming operators equal their batch counterparts on closed windows."""

from pyspark.sql import functions as F

from conftest import SF001, rows
from mercato.operators import sessions
from mercato.plans import params as P
from mercato.schemas import RAW_EVENTS
from mercato.session import scratch_path
from mercato.sources import tables as T
from mercato.streaming import ingest


def _landing(spark, copies=1, files=None):
    raw = T.read(spark, SF001, "events").select(*[f.name for f in RAW_EVENTS.fields])
    data = raw
    for _ in range(copies - 1):
        data = data.unionByName(raw)
    if files:  # every file has events of all days
        return ingest.land(data, scratch_path(spark, "t-landing"), F.pmod(F.xxhash64("event_id"), F.lit(files)), files=files)
    return ingest.land(data, scratch_path(spark, "t-landing"), F.to_date("ts"))


SESSION_COLS = ["customer_id", "session_id", "event_timestamp_min", "event_timestamp_max", "event_timestamp_count",
                "product_views_sum", "add_to_cart_sum", "checkout_started_sum", "purchase_completed_sum"]


def test_stream_sessions_equal_batch_whatever_the_order(spark):
    out = ingest.sessions_stream(spark, _landing(spark, files=5), scratch_path(spark, "t-sess"), scratch_path(spark, "t-ck"),
                                 P.SESSION_GAP_SECONDS, max_files_per_trigger=1)
    batch = sessions.session_behavior(T.web_events(spark, SF001, gap_seconds=P.SESSION_GAP_SECONDS))
    assert rows(out.select(*SESSION_COLS)) == rows(batch.select(*SESSION_COLS))


def test_stream_sessions_replayed_batch_changes_nothing(spark):
    landing, out = _landing(spark, files=3), scratch_path(spark, "t-sess")
    once = rows(ingest.sessions_stream(spark, landing, out, scratch_path(spark, "t-ck"), max_files_per_trigger=2).select(*SESSION_COLS))
    again = rows(ingest.sessions_stream(spark, landing, out, scratch_path(spark, "t-ck"), max_files_per_trigger=1).select(*SESSION_COLS))
    assert once == again


def test_stream_dedup_removes_redelivery(spark):
    out = ingest.dedup_events_stream(spark, _landing(spark, copies=2, files=4), scratch_path(spark, "t-dd"),
                                     scratch_path(spark, "t-ck"), max_files_per_trigger=1)
    assert out.count() == T.read(spark, SF001, "events").count()
    assert out.select("event_id").distinct().count() == out.count()


def test_stream_ingest_exactly_once_on_restart(spark):
    landing = _landing(spark)
    out, ck = scratch_path(spark, "t-ing"), scratch_path(spark, "t-ck")
    first_df = ingest.ingest_events(spark, landing, out, ck)
    first = first_df.count()
    second = ingest.ingest_events(spark, landing, out, ck).count()  # same checkpoint: nothing new
    assert first == second == T.read(spark, SF001, "events").count()
    assert first_df.filter(F.col("load_timestamp").isNull()).count() == 0


def test_stream_daily_metrics_are_complete(spark):
    out = ingest.daily_metrics_stream(spark, _landing(spark, files=4), scratch_path(spark, "t-dm"), scratch_path(spark, "t-ck"),
                                      max_files_per_trigger=1)
    ev = T.read(spark, SF001, "events")
    batch = {(r[0], r[1], r[2]) for r in ev.groupBy(F.to_date("ts")).agg(F.count("*"), F.countDistinct("user_id")).collect()}
    assert {(r.metric_date, r.events, r.visitors) for r in out.collect()} == batch


def test_orders_upsert_keeps_the_greatest_sequence(spark):
    import datetime as dt
    from decimal import Decimal

    schema = "order_id long, order_date timestamp_ntz, order_total decimal(18,2), load_seq int"
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    batches = [[(1, jan, Decimal(1), 5), (2, jan, Decimal(2), 1), (3, jan, Decimal(3), 1), (4, None, Decimal(4), 1)],
               [(1, feb, Decimal(9), 4), (2, feb, Decimal(8), 2)],  # 1 is stale, 2 moves
               [(3, feb, Decimal(7), 2), (1, feb, Decimal(6), 6), (4, feb, Decimal(5), 2)]]  # January is left empty
    target = scratch_path(spark, "t-target")
    for i, b in enumerate(batches):
        landing = ingest.land(spark.createDataFrame(b, schema), scratch_path(spark, f"t-orders-{i}"))
        for _ in range(2):  # each load twice: the second changes nothing
            out = ingest.orders_upsert_stream(spark, landing, target, scratch_path(spark, "t-ck"), spark.createDataFrame(b, schema).schema)
        got = {r.order_id: (r.order_date, int(r.order_total), r.load_seq) for r in out.collect()}
        if i == 1:
            assert got == {1: (jan, 1, 5), 2: (feb, 8, 2), 3: (jan, 3, 1), 4: (None, 4, 1)}
    assert got == {1: (feb, 6, 6), 2: (feb, 8, 2), 3: (feb, 7, 2), 4: (feb, 5, 2)}
    assert out.count() == 4 and {str(r.order_month) for r in out.collect()} == {"2024-02-01"}


def test_orders_upsert_is_idempotent_and_latest_wins(spark):
    o = T.orders(spark, SF001)
    first = o.withColumn("load_seq", F.lit(1))
    later = o.filter(F.col("order_status") == "pending").withColumn("order_status", F.lit("completed")) \
        .withColumn("load_seq", F.lit(2))
    landing = scratch_path(spark, "t-orders")
    ingest.land(first.unionByName(later), landing)
    target = scratch_path(spark, "t-target")
    out = ingest.orders_upsert_stream(spark, landing, target, scratch_path(spark, "t-ck"), first.schema)
    n = o.count()
    assert out.count() == n and out.select("order_id").distinct().count() == n
    assert out.filter(F.col("order_status") == "pending").count() == 0
    # replay the same files with a fresh checkpoint: same table
    again = ingest.orders_upsert_stream(spark, landing, target, scratch_path(spark, "t-ck"), first.schema)
    assert again.count() == n


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _event(i, when, user=1, kind="view"):
    import datetime as dt

    return (i, when and dt.datetime.fromisoformat(when), user, kind, 1.0, None)


def _batches(spark, batches, run):
    """Land batches one after another into one stream's folder."""
    for i, b in enumerate(batches):
        landing = ingest.land(spark.createDataFrame(b, EVENTS), scratch_path(spark, f"t-b{i}"))
        out = run(landing)
    return out


MOVED = [[_event(1, "2024-01-01 10:00:00"), _event(2, "2024-01-01 10:30:00"), _event(3, None), _event(4, "2024-01-02 09:00:00", None)],
         [_event(1, "2024-01-05 10:00:00"), _event(5, "2023-01-01 00:10:00")],  # 1 moves; 5 is a year late
         [_event(1, "2024-01-03 10:00:00"), _event(3, "2024-01-01 11:00:00")],  # an older delivery of 1; 3 gets a time
         [_event(2, "2024-01-04 23:00:00"), _event(6, "2024-01-05 04:00:00", 1, "purchase")]]


def _latest():
    best = {}
    for b in MOVED:
        for e in b:
            if e[0] not in best or (e[1] is not None and (best[e[0]][1] is None or e[1] > best[e[0]][1])):
                best[e[0]] = e
    return best


def test_moved_deliveries_in_any_order_of_batches(spark):
    import itertools

    for order in itertools.permutations(range(4)):
        if order[0] not in (0, 3):
            continue
        out = scratch_path(spark, "t-mv")
        got = _batches(spark, [MOVED[i] for i in order],
                       lambda landing: ingest.dedup_events_stream(spark, landing, out, scratch_path(spark, "t-ck")))
        assert {r.event_id: r.ts for r in got.collect()} == {i: e[1] for i, e in _latest().items()}, order
        assert got.count() == 6
        if order != (0, 1, 2, 3):
            break


def test_daily_metrics_and_sessions_follow_moved_events(spark):
    out, sess = scratch_path(spark, "t-dm"), scratch_path(spark, "t-ss")
    daily = _batches(spark, MOVED, lambda x: ingest.daily_metrics_stream(spark, x, out, scratch_path(spark, "t-ck")))
    days = {}
    for e in _latest().values():
        days.setdefault(e[1] and e[1].date(), []).append(e)
    assert {(r.metric_date, r.events, r.visitors) for r in daily.collect()} == {
        (d, len(es), len({e[2] for e in es if e[2]})) for d, es in days.items()}
    got = _batches(spark, MOVED, lambda x: ingest.sessions_stream(spark, x, sess, scratch_path(spark, "t-ck"), 6 * 3600))
    ev = spark.createDataFrame([e for e in _latest().values() if e[1]], EVENTS)
    from mercato.sources.tables import events_from_raw

    batch = sessions.session_behavior(sessions.sessionize(events_from_raw(ev), 6 * 3600))
    assert rows(got.select(*SESSION_COLS)) == rows(batch.select(*SESSION_COLS))


def test_failure_between_staging_and_result_is_made_good(spark, monkeypatch):
    """The batch that moves an event fails after staging; run again, it also
    counts the day that the event has left."""
    import pytest

    out, ck = scratch_path(spark, "t-fail"), scratch_path(spark, "t-ck")
    landing = scratch_path(spark, "t-land")
    spark.createDataFrame(MOVED[0], EVENTS).write.parquet(landing)
    ingest.daily_metrics_stream(spark, landing, out, ck)
    spark.createDataFrame(MOVED[1], EVENTS).write.mode("append").parquet(landing)
    whole = ingest.overwrite_partitions

    def fail(target, *args):
        if target == out:
            raise RuntimeError("lost")
        return whole(target, *args)

    monkeypatch.setattr(ingest, "overwrite_partitions", fail)
    with pytest.raises(Exception, match="lost"):
        ingest.daily_metrics_stream(spark, landing, out, ck)
    monkeypatch.setattr(ingest, "overwrite_partitions", whole)
    got = {str(r.metric_date): r.events for r in ingest.daily_metrics_stream(spark, landing, out, ck).collect()}
    assert got == {"2024-01-01": 1, "None": 1, "2024-01-02": 1, "2024-01-05": 1, "2023-01-01": 1}


def test_ingest_runs_several_batches(spark):
    landing, out, ck = _landing(spark, files=6), scratch_path(spark, "t-ing"), scratch_path(spark, "t-ck")
    got = ingest.ingest_events(spark, landing, out, ck, max_files_per_trigger=2)
    assert got.count() == T.read(spark, SF001, "events").count()
    batches = spark.read.text(f"{ck}/commits").select(F.input_file_name().alias("f")).distinct().count()
    assert batches >= 3


def _stateful(spark, batches, **kw):
    """Land batches in turn and drain the stream after each; rows by kind."""
    from mercato.streaming import stateful

    landing, out, ck = (scratch_path(spark, f"t-{x}") for x in ("land", "out", "ck"))
    for b in batches:
        spark.createDataFrame(b, EVENTS).coalesce(1).write.mode("append").parquet(landing)
        got = stateful.stateful_sessions(spark, landing, out, ck, **kw)
    return got.collect()


def test_stateful_sessions_late_and_duplicate_rows(spark):
    batches = [[_event(1, "2024-01-01 10:00:00"), _event(2, "2024-01-01 10:30:00", 1, "purchase"), _event(3, "2024-01-01 10:00:00", 2),
                _event(90, None), _event(91, "2024-01-01 10:00:00", None)],
               [_event(2, "2024-01-02 01:00:00"), _event(4, "2024-01-01 11:00:00")],  # a re-delivery with another day; a session grows
               [_event(5, "2024-01-09 00:00:00", 3)],  # the watermark passes both sessions
               [_event(6, "2024-01-01 12:00:00"), _event(7, "2024-01-09 01:00:00", 3)]]  # far too late
    rows_ = _stateful(spark, batches, gap_seconds=6 * 3600)
    sessions_ = {(r.customer_id, r.events, r.product_views, r.purchase_completed, r.last_us - r.first_us) for r in rows_ if r.kind == "session"}
    assert sessions_ == {(1, 3, 2, 1, 3_600_000_000), (2, 1, 1, 0, 0)}
    assert {(r.kind, r.event_id) for r in rows_ if r.kind != "session"} == {("duplicate", 2), ("late", 6)}
    # rows in = events of sessions + late + duplicate + still held (5, 7); two without a user or a time
    assert sum(r.events for r in rows_) + 2 + 2 == sum(map(len, batches))


def test_stateful_sessions_survive_restarts(spark):
    """One batch a run, and all batches in one run, give the same sessions."""
    import datetime as dt
    import random

    from mercato.streaming import stateful

    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    batches = [[(100 * d + i, start + dt.timedelta(days=d, minutes=rnd.randrange(1440)), rnd.randrange(4), rnd.choice(["view", "click"]), 1.0, None)
                for i in range(40)] for d in range(4)]
    each = _stateful(spark, batches, gap_seconds=1800, delay="1 hour")
    landing = scratch_path(spark, "t-land")
    for b in batches:
        spark.createDataFrame(b, EVENTS).coalesce(1).write.mode("append").parquet(landing)
    once = stateful.stateful_sessions(spark, landing, scratch_path(spark, "t-out"), scratch_path(spark, "t-ck"), 1800, "1 hour").collect()
    assert sorted(map(str, each)) == sorted(map(str, once)) and {r.kind for r in once} == {"session"}
    mark = max(e[1] for b in batches for e in b) - dt.timedelta(hours=1)
    closed = 0
    for user in range(4):
        times = sorted(e[1] for b in batches for e in b if e[2] == user)
        ends = [t for t, n in zip(times, [*times[1:], None]) if n is None or n - t >= dt.timedelta(seconds=1800)]
        closed += sum(t + dt.timedelta(seconds=1800) <= mark for t in ends)
    assert len(once) == closed


def _written(spark, events, files):
    """An ``events`` table of several files, each with events of all days."""
    sf = scratch_path(spark, "t-sf")
    spark.createDataFrame(events, EVENTS).repartition(files).write.parquet(f"{sf}/events.parquet")
    return sf


def test_closed_sessions_whatever_the_number_of_files(spark):
    """A week's rows are in several files; none is late for another."""
    import datetime as dt
    import random

    from mercato.plans.catalog_io import q_stream_sessions_closed

    rnd, start = random.Random(5), dt.datetime(2024, 1, 3)
    events = [(i, start + dt.timedelta(minutes=rnd.randrange(20 * 1440)), rnd.randrange(40), rnd.choice(["view", "purchase", None]), 1.0, None)
              for i in range(2000)] + [_event(9000, None), _event(9001, "2024-01-05 00:00:00", None)]
    got = q_stream_sessions_closed(spark, _written(spark, events, 8)).collect()
    gap, mark = dt.timedelta(seconds=P.SESSION_GAP_SECONDS), max(e[1] for e in events if e[1]) - dt.timedelta(days=1)
    want = []
    for user in range(40):
        part = []
        for e in [*sorted((e for e in events if e[2] == user and e[1]), key=lambda e: e[1]), None]:
            if part and (e is None or e[1] - part[-1][1] >= gap):
                if part[-1][1] + gap <= mark:
                    want.append((user, part[0][1], part[-1][1], len(part), sum(x[3] == "view" for x in part), sum(x[3] == "purchase" for x in part)))
                part = []
            part.append(e)
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 100


def test_closed_sessions_without_a_row(spark):
    from mercato.plans.catalog_io import q_stream_sessions_closed

    assert q_stream_sessions_closed(spark, _written(spark, [_event(1, None)], 1)).collect() == []


def test_stateful_sessions_hold_a_row_a_bucket(spark):
    """Calls to the state store grow with the buckets, not with the users; a
    session that ends a gap before the watermark to the millisecond is closed."""
    from mercato.streaming import stateful

    landing, out, ck = (scratch_path(spark, f"t-{x}") for x in ("land", "out", "ck"))
    batches = [[_event(u, "2024-01-01 10:00:00", u) for u in range(3000)], [_event(9000, "2024-01-02 16:00:00", 9000)]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, EVENTS).write.mode("append").parquet(landing)
        got = stateful.stateful_sessions(spark, landing, out, ck, 6 * 3600, max_files_per_trigger=None, closing=i == 1)
        if i == 0:  # all are held
            held = spark.read.format("statestore").option("path", ck).option("stateVarName", "held").load()
            assert 0 < held.count() <= stateful.BUCKETS
            assert got.count() == 0
    assert sorted((r.kind, r.customer_id, r.events) for r in got.collect()) == [("session", u, 1) for u in range(3000)]


class _Store:
    """The store of one bucket, in memory."""

    value, timers = None, ()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, t):
        self.timers = (*self.timers, t)

    def deleteTimer(self, t):
        self.timers = tuple(x for x in self.timers if x != t)


def test_session_processor_against_plain_rules(monkeypatch):
    """Packed events of one bucket against one event at a time: sessions, late
    and repeated rows, events that stay, and the timer."""
    import random

    import numpy as np
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql.streaming.stateful_processor import TimerValues

    from mercato.streaming import stateful

    monkeypatch.setattr(stateful, "PACK", 50)
    monkeypatch.setattr(stateful, "PACKED", 7)
    rnd, gap, store = random.Random(11), 3_000_000, _Store()
    proc = stateful.SessionProcessor(gap)
    proc.init(store)
    held, seen = {}, set()
    for mark_ms in (0, 4_000, 4_000, 9_001, 20_000, 60_000):
        rows_ = [(rnd.randrange(-2, 5), rnd.randrange(60), rnd.randrange(mark_ms * 1000 - 2_000_000, mark_ms * 1000 + 20_000_000), rnd.randrange(5))
                 for _ in range(rnd.choice([1, 30, 130]))] if mark_ms < 60_000 else []
        batches = [pa.RecordBatch.from_arrays([pa.array([3] * len(x), pa.int32()), *[pa.array(c, pa.int64()) for c in zip(*x)]], names=list("abcde"))
                   for x in (rows_[:60], rows_[60:]) if x]
        packed = [(b, e) for x in stateful._pack(iter(batches)) for b, e in zip(*(c.to_pylist() for c in x.columns))]
        assert {b for b, _ in packed} <= {3} and all(len(e) <= 7 * 32 for _, e in packed)
        assert [tuple(x) for _, e in packed for x in np.frombuffer(e, np.int64).reshape(-1, 4).tolist()] == rows_
        frames = iter([pd.DataFrame({"events": [e]}) for _, e in packed])
        times = TimerValues(-1, mark_ms)
        out = list(proc.handleInputRows((3,), frames, times) if rows_ else proc.handleExpiredTimer((3,), times, None))
        got = sorted(tuple(None if pd.isna(v) else v for v in r) for f in out for r in f[stateful.COLUMNS].itertuples(index=False))

        want, mark = [], mark_ms * 1000
        for user, i, us, kind in rows_:
            tag = "late" if us < mark else "duplicate" if i in [e[1] for e in held.get(user, [])] else None
            if tag:
                want.append((tag, user, us, us, 1, 0, 0, 0, 0, i))
                seen.add(tag)
            else:
                held.setdefault(user, []).append((us, i, kind))
        open_ends = []
        for user, events in held.items():
            stretches = []
            for e in sorted(events):
                if not stretches or e[0] - stretches[-1][-1][0] >= gap:
                    stretches.append([])
                stretches[-1].append(e)
            held[user] = []
            for s in stretches:
                if s[-1][0] + gap <= mark:
                    want.append(("session", user, s[0][0], s[-1][0], len(s), *[sum(e[2] == k for e in s) for k in range(1, 5)], None))
                    seen.add("session")
                else:
                    held[user] += s
                    open_ends.append(s[-1][0] + gap)
        assert got == sorted(want)
        # the timer's time is before the first whole millisecond that closes a session
        assert store.timers == ((-(-min(open_ends) // 1000) - 1,) if open_ends else ()) and (store.value is None) == (not open_ends)
    assert seen == {"late", "duplicate", "session"} and not any(held.values())
