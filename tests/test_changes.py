"""Aggregates from changes, sketches, curve layout, VARIANT landing, as-of sweep."""

import datetime as dt
import glob
import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF01, rows
from mercato.functions.expressions import epoch_micros
from mercato.operators import incremental, scd, sketches
from mercato.session import scratch_path
from mercato.sources import files, sinks
from mercato.sources import tables as T

DAY = dt.date(2024, 1, 1)


def _rows(spark, data):
    return spark.createDataFrame(data, "id long, day date, who long, amount long").withColumn("amount", F.col("amount").cast("decimal(10,2)"))


def test_signed_changes_of_inserts_updates_deletes(spark):
    old = _rows(spark, [(1, DAY, 1, 1), (2, DAY, 1, 2), (3, None, None, 3)])
    new = _rows(spark, [(1, DAY, 1, 1), (2, DAY, 1, 5), (4, DAY, 2, 4)])
    got = {(r.id, r._sign, r.amount and int(r.amount)) for r in incremental.signed_changes(old, new, "id", ["day", "who", "amount"]).collect()}
    assert got == {(2, -1, 2), (2, 1, 5), (3, -1, 3), (4, 1, 4)}


def test_merges_equal_the_full_aggregate_run_after_run(spark):
    rnd = random.Random(2)
    table = {i: (i, DAY + dt.timedelta(rnd.randrange(4)), rnd.randrange(5), rnd.randrange(9)) for i in range(60)}
    path, seen = scratch_path(spark, "t-agg"), scratch_path(spark, "t-seen")
    keys = {"day": F.col("day"), "who": F.col("who")}
    before = _rows(spark, [])
    for _ in range(3):
        for i in list(table):
            kind = rnd.randrange(4)
            if kind == 0:
                del table[i]
            elif kind == 1:
                table[i] = (i, rnd.choice([None, DAY, DAY + dt.timedelta(9)]), rnd.choice([None, 1, 2]), rnd.randrange(9))
        table.update({i: (i, DAY, 3, 1) for i in rnd.sample(range(100, 200), 5)})
        now = _rows(spark, list(table.values()))
        changes = incremental.signed_changes(before, now, "id", ["day", "who", "amount"])
        step = incremental.delta(changes, {"day": F.col("day")}, {"amount": F.col("amount")})
        got = incremental.merge_delta(path, "day", ["day"], step)
        want = now.groupBy("day").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))
        key = lambda x: [tuple(str(v) for v in r) for r in x]
        assert sorted(key(got.select("day", "rows", "amount").collect())) == sorted(key(want.select("day", "rows", "amount").collect()))
        visits = incremental.merge_delta(seen, "day", ["day", "who"], incremental.delta(changes, keys, {}))
        counted = incremental.distinct_by_day(visits, "day", "who", "visitors")
        want = now.groupBy("day").agg(F.count("*").alias("rows"), F.countDistinct("who").alias("visitors"))
        assert sorted(key(counted.select("day", "rows", "visitors").collect())) == sorted(key(want.select("day", "rows", "visitors").collect()))
        before = now


def test_a_merge_touches_its_days_only(spark):
    path = scratch_path(spark, "t-agg")
    one = spark.createDataFrame([(DAY, 1), (DAY + dt.timedelta(1), 2)], "day date, rows long")
    incremental.merge_delta(path, "day", ["day"], one)
    local = path.removeprefix("file:")
    kept = set(glob.glob(f"{local}/day={DAY}/*.parquet"))
    incremental.merge_delta(path, "day", ["day"], spark.createDataFrame([(DAY + dt.timedelta(1), -2)], "day date, rows long"))
    assert set(glob.glob(f"{local}/day={DAY}/*.parquet")) == kept and len(kept) == 1
    assert not glob.glob(f"{local}/day={DAY + dt.timedelta(1)}/*")  # nothing of that day is left


def test_sketches_of_ranges(spark):
    rnd = random.Random(4)
    data = [(rnd.randrange(30_000), DAY + dt.timedelta(rnd.randrange(20))) for _ in range(60_000)]
    ev = spark.createDataFrame(data, "customer_id long, event_timestamp date")
    days = sinks.materialize_table(sketches.daily_visitors(ev), "t-sketches")
    for lo, hi in ((0, 0), (0, 6), (3, 19)):
        a, b = DAY + dt.timedelta(lo), DAY + dt.timedelta(hi)
        r = sketches.visitors_between(days, str(a), str(b)).first()
        exact = {c for c, d in data if a <= d <= b}
        assert abs(r.visitors - len(exact)) <= 4 * sketches.ERROR * len(exact)
        assert r.events == sum(a <= d <= b for _, d in data)
    plan = sketches.visitors_between(days, str(DAY), str(DAY))._jdf.queryExecution().executedPlan().toString()
    assert "event_timestamp" not in plan  # the days are read, no event


def _groups_read(path, column, value):
    """Share of the row groups whose statistics do not exclude a value."""
    read = total = 0
    for f in glob.glob(path.removeprefix("file:") + "/*.parquet"):
        m = pq.ParquetFile(f).metadata
        i = m.schema.names.index(column)
        for g in range(m.num_row_groups):
            s = m.row_group(g).column(i).statistics
            total, read = total + 1, read + (s.min <= value <= s.max)
    return read / total


def test_curve_layout_skips_by_either_key(spark):
    ev = T.raw_events(spark, SF01).where("customer_id IS NOT NULL").select("event_id", "customer_id", epoch_micros("event_timestamp").alias("us"))
    path, plain = scratch_path(spark, "t-curve"), scratch_path(spark, "t-sorted")
    out = sinks.curve_write(ev, path, [F.col("us"), F.col("customer_id")], num_partitions=64)
    sinks.clustered_write(ev, plain, ["us", "customer_id"], num_partitions=64)
    assert rows(out) == rows(ev)
    middle = ev.agg(F.percentile_approx("us", 0.5), F.percentile_approx("customer_id", 0.5)).first()
    curve = [_groups_read(path, c, v) for c, v in zip(("us", "customer_id"), middle)]
    assert max(curve) < 0.35, curve
    assert _groups_read(plain, "customer_id", middle[1]) > 0.9  # a sort serves its first key alone


def test_curve_of_nulls_ties_and_nothing(spark):
    df = spark.createDataFrame([(None, 1, "a"), (5, None, "b"), (5, 5, "c"), (5, 5, "c")], "x long, y long, _z string")
    key = lambda x: sorted(map(str, x.collect()))
    assert key(sinks.curve_write(df, scratch_path(spark, "t-c"), [F.col("x"), F.col("y")])) == key(df)
    empty = df.limit(0)
    assert sinks.curve_write(empty, scratch_path(spark, "t-c"), [F.col("x"), F.col("y")]).count() == 0


def test_variant_landing_keeps_every_line(spark):
    lines = [json.dumps({"event_id": 1, "ts": "2024-01-01T00:00:00.000001", "user_id": 2, "event_type": "view", "value": 1.5, "props": "{}"}),
             json.dumps({"event_id": 2, "ts": "never", "user_id": None, "value": "x", "new": {"a": [1]}}),
             json.dumps({"event_id": "x"}), json.dumps({"event_id": 2.5}), "{broken", "", "[1]", "7", '"text"', "null", json.dumps({"other": 1})]
    path = scratch_path(spark, "t-lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    events, rescue = files.read_variant_events(spark, path)
    got = {r.event_id: r for r in events.collect()}
    assert set(got) == {1, 2} and got[1].rescued is None and got[1].ts == dt.datetime(2024, 1, 1, 0, 0, 0, 1) and got[1].value == 1.5
    assert json.loads(got[2].rescued) == {"ts": "never", "value": "x", "new": '{"a":[1]}'} and got[2].ts is None
    reasons = {r.line: r.reason for r in rescue.collect()}
    assert len(reasons) == len(lines) - 2
    assert reasons["{broken"] == "malformed" and reasons["[1]"] == reasons["7"] == "not an object"
    assert reasons[json.dumps({"event_id": "x"})] == reasons[json.dumps({"other": 1})] == "no event_id"


@pytest.mark.parametrize("hot", [None, 40, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_sweep_equals_the_range_join(spark, hot, how):
    rnd = random.Random(5)
    versions, facts = [], []
    for k in range(6):
        day = DAY
        cuts = sorted(rnd.sample(range(200), rnd.choice([1, 2, 30]) + 1))
        for a, b in zip(cuts, [*cuts[1:], None]):
            versions.append((k, f"v{k}-{a}", DAY + dt.timedelta(a), None if b is None or rnd.random() < .1 else DAY + dt.timedelta(b)))
        # an early end leaves a gap without a version
        facts += [(rnd.randrange(10**6), rnd.choice([k, k, 0, None, 99]), day + dt.timedelta(rnd.randrange(-5, 210))) for _ in range(60)]
    versions = [(k, a, e, (x if x is None else x - dt.timedelta(rnd.choice([0, 0, 1])))) for k, a, e, x in versions]
    # one open version a key at most
    versions = [v if v[3] is not None or i == len(versions) - 1 or versions[i + 1][0] != v[0] else (*v[:3], versions[i + 1][2]) for i, v in enumerate(versions)]
    versions = [v for v in versions if v[3] is None or v[3] > v[2]]
    facts.append((1, 0, None))
    f = spark.createDataFrame(facts, "id long, key long, at date").repartition(3)
    d = spark.createDataFrame(versions, "key long, name string, effective_date date, expiry_date date")
    key = lambda x: sorted(map(str, x.collect()))
    assert key(scd.scd2_sweep(f, d, "key", "at", ["name"], how, hot)) == key(scd.scd2_lookup(f, d, "key", "at", ["name"], how))
