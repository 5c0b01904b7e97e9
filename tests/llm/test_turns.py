"""Conversation repair against enumeration of all edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from mercato.llm import catalog, turns

BLANK = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = BLANK.findall(text)
        out.append("blank" if not last else "duplicate" if (role, text) in seen
                   else "" if last[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_repair(rows):
    """(cost, audit, messages) of every way with at most two inserts in a row."""
    faults = faults_of(rows)
    inserts = ["", "u", "a", "ua", "au"]
    choices = [[("D", None)] if f in ("blank", "duplicate") else [("D", None), ("K", None), ("R", "user"), ("R", "assistant")]
               for f in faults]
    for gaps in product(inserts, repeat=len(rows) + 1):
        for edits in product(*choices):
            cost, audit, out = 0, "", []
            for i, gap in enumerate(gaps):
                for x in gap:
                    cost, audit = cost + 2, audit + "I"
                    out.append(({"u": "user", "a": "assistant"}[x], ""))
                if i < len(rows):
                    edit, role = edits[i]
                    audit += edit
                    cost += {"D": 3, "K": 0, "R": 2}[edit] + (edit != "D" and faults[i] == "truncated")
                    if edit != "D":
                        out.append((role or rows[i][1], rows[i][2]))
            yield cost, audit, out


def brute(rows):
    def legal(out):
        return all(r[:1] in ("s", "u", "a") for r, _ in out) and GOOD.fullmatch("".join(r[:1] for r, _ in out))

    return min((c, a, o) for c, a, o in every_repair(rows) if legal(o))


def test_one_conversation_against_all_edits():
    rng = random.Random(5)
    for _ in range(120):
        rows = [(i, rng.choice(["user", "assistant", "system", "", "tool"]), rng.choice(["a.", "b?", "c", " \t", "a."]))
                for i in range(rng.randrange(4))]
        got = turns.repair_one(rows)
        cost, audit, out = brute(rows)
        assert (got[5], got[6]) == (cost, audit), rows
        assert [(r, t) for _, _, r, t in got[7]] == out
        assert list(got[1:4]) == [faults_of(rows).count(k) for k in ("blank", "duplicate", "truncated")]


def test_slices_chain_to_the_same_path():
    rng = random.Random(6)
    for n in (1, 2, 7, 40):
        initials = "".join(rng.choice("sua?") for _ in range(n))
        faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        ends = turns.paths(initials, faults, turns.NOTHING)
        best = turns.read_path(min((ends[q] for q in (0, 3) if ends[q]), key=lambda x: x[0]), n)
        for size in (1, 3, 10):
            cut = [(initials[i:i + size], faults[i:i + size]) for i in range(0, n, size)]
            read = [[(None, None) if x is None else turns.read_path(x, len(f)) for s in range(4) for x in turns.paths(i, f, s)]
                    for i, f in cut]
            cost, steps = turns.chain([[c for c, _ in m] for m in read], [[a for _, a in m] for m in read])
            assert (cost, "".join(a for _, a in steps)) == best


def plain(rows):
    """{conv_id: result} of conversation rows, damaged and repaired in plain Python."""
    text = lambda v: " " if v is None else str(v)
    convs = {}
    for cid, turn, role, body in rows:
        kept = convs.setdefault(cid, [])
        role, body, kind = text(role), text(body), zlib.crc32(f"{text(cid)}:{text(turn)}".encode()) % 20
        if kind:
            body = "" if kind == 1 else re.sub("[.!?]", "", body) if kind == 2 else body
            kept += [(turn, "user" if kind == 4 else role, body)] * (2 if kind == 3 else 1)
    out = {}
    for cid, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        known = [t for t, _, _ in kept if t is not None]
        roles = [r[:1] for _, r, _ in kept]
        _, *counts, cost, audit, messages = turns.repair_one(kept)
        found = faults_of(kept)
        assert counts[:3] == [found.count(k) for k in ("blank", "duplicate", "truncated")]
        out[cid] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *counts[:3],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in messages).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, cost string, part int"


def table():
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "", "Tool"]),
             rng.choice(["yes.", "no!", "half", None, "", " \n", "é?", "long " * 500 + "."]), "x", 1)
            for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, None, "user", "a.", None, None), (None, None, "assistant", "b.", None, None), (61, None, None, None, None, None)]
    rows += [(62, t // 3, rng.choice(["user", "assistant"]), rng.choice(["x.", "y", "z?", f"{t}."]), None, None) for t in range(300)]
    return rows + rows[:20]


@pytest.mark.parametrize("slice_rows", [turns.SLICE_ROWS, 25])
def test_tables_with_odd_rows_and_large_conversations(spark, slice_rows):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = turns.with_digest(turns.repair(turns.damage(df), slice_rows=slice_rows)).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == plain([r[:4] for r in rows])
    assert len(got) == len({r[0] for r in rows})


def test_large_conversation_is_cut_into_slices(spark):
    df = spark.createDataFrame([(1, t, "user", f"{t}.", None, None) for t in range(500)], SCHEMA)
    out = turns.repair(df, slice_rows=50).select("slice", "slices", F.size("messages").alias("n")).collect()
    assert len(out) >= 10 and {r["slices"] for r in out} == {len(out)} and sorted(r["slice"] for r in out) == list(range(len(out)))
    assert max(r["n"] for r in out) <= 151  # 50 rows and what is inserted between them


def test_empty_table_and_query(spark):
    assert catalog.queries()["op13_conversation_repair"](spark, SF001).count() > 0
    assert turns.with_digest(turns.repair(turns.damage(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = catalog.queries()["op13_conversation_repair"](spark, SF001).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == plain(rows)
