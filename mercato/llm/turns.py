"""Conversation structure repair by scalar big-integer weights.

``repair`` finds the cheapest edits that make a conversation's roles read
``(s?(ua)+)?`` (s: system, u: user, a: assistant; only initials count), and of
equally cheap ones those whose letters come first in ASCII:

* Keep (K) costs 0, Rerole (R) to user or assistant 2, Delete (D) 3, Insert (I)
  of an empty user or assistant message 2; a blank or duplicate row must be
  deleted, a truncated row that is not adds 1.

The edits of a conversation are a path in a DAG whose nodes are (rows consumed,
state), the states being: nothing yet, after s, after u, after a.  The weight of
a path is one whole number: the high digits are its cost, and below them lie as
many digits as a path can have letters, the j-th letter in the j-th digit from
the top (D, I, K, R as 1 to 4 in ASCII order) and zeros behind the last.  The
least number is the cheapest path with the least letters, so ordinary minimum of
integers decides everything.  (Paths to one node that cost the same are never
one the beginning of the other: they consume the same rows, so the longer one
would end in inserts that lead back to the same state and cost more.  Therefore
the minimum at a node is part of the minimum at the end.)

Rows of a conversation are taken by turn (nulls first), then role and text.
A row's first fault counts: blank (no character but blanks and controls
0x09-0x0D), duplicate (same role and text earlier in the conversation),
truncated (the last such character is not one of ``.!?``).

Scale.  One shuffle by conversation; each is decided in one task while it has at
most ``SLICE_ROWS`` rows and ``SLICE_TEXT`` bytes.  Larger ones are range
partitioned by their order and cut into slices of that size: a slice's task
gives the least path between any two states, a pass over slices (not rows)
chains them, and a co-group by slice writes the messages.  No task holds a large
conversation's rows; the chaining task holds its letters (about 12 bytes a row).

Result: one row a slice (ordinary conversations: one) with ``slice`` and
``slices``, the counts and cost of the whole conversation, the slice's ``audit``
and its repaired ``messages``.

Defined cases.  Null role and text are one blank.  Null turns come first and
count for no gap.  Null conv_ids are one conversation.  A role without a known
initial, also the empty one, can be reroled or deleted, not kept.  Rows whose
``present`` is false name a conversation without giving it a row; one without
rows has zeros and no message.  Other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import written

#: Rows and bytes of text up to which a conversation is one slice.
SLICE_ROWS = 4096
SLICE_TEXT = 16 << 20

LETTERS = "DIKR"
BITS = 3  # of a letter's digit
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
NEEDED = "uuau"  # the initial that continues each state
THEN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)


def _cost_unit(rows: int) -> int:
    """Bits below the cost: a path has a letter a row and at most two inserts
    before each row and at the end."""
    return BITS * (3 * rows + 2)


def paths(initials: str, faults: list[int], start: int) -> list:
    """For each end state the least (weight, bits below the last letter) of the
    paths from ``start`` over all rows, None if there is none.  ``initials``
    has one character a row, ``?`` for a role that cannot be kept."""
    below = _cost_unit(len(faults))
    unit = 1 << below

    def edge(node, cost, letter):
        weight, left = node
        return weight + cost * unit + (letter << (left - BITS)), left - BITS

    def least(a, b):
        return a if b is None or (a is not None and a[0] <= b[0]) else b

    def inserted(at):
        u = at[AFTER_U]
        for q in (NOTHING, AFTER_S, AFTER_A):
            if at[q] is not None:
                u = least(u, edge(at[q], 2, 2))
        a = at[AFTER_A] if u is None else least(at[AFTER_A], edge(u, 2, 2))
        return [at[NOTHING], at[AFTER_S], u, a]

    at: list = [None] * 4
    at[start] = (0, below)
    for initial, fault in zip(initials, faults):
        at = inserted(at)
        new: list = [None if x is None else edge(x, 3, 1) for x in at]
        if fault not in (BLANK, DUPLICATE):
            more = int(fault == TRUNCATED)
            for q, x in enumerate(at):
                if x is None:
                    continue
                if initial == NEEDED[q]:
                    new[THEN[q]] = least(new[THEN[q]], edge(x, more, 3))
                elif q == NOTHING and initial == "s":
                    new[AFTER_S] = least(new[AFTER_S], edge(x, more, 3))
                new[THEN[q]] = least(new[THEN[q]], edge(x, 2 + more, 4))
        at = new
    return inserted(at)


def read_path(node, rows: int) -> tuple[int, str]:
    """(cost, letters) of a weight."""
    weight, left = node
    below = _cost_unit(rows)
    letters = (weight & ((1 << below) - 1)) >> left
    digits = oct(letters)[2:] if below > left else ""
    return weight >> below, "".join(LETTERS[int(d) - 1] for d in digits)


def replay(audit: str, state: int, rows: list[tuple]) -> tuple[list[tuple], int]:
    """Messages (edit, turn, role, text) that an audit makes of rows (turn,
    role, text) from a state, and the state after them."""
    out, at = [], iter(rows)
    for letter in audit:
        if letter == "I":
            initial = NEEDED[state]
            out.append(("I", None, ROLE[initial], ""))
            state = THEN[state]
            continue
        turn, role, text = next(at)
        if letter == "D":
            continue
        if letter == "R":
            role = ROLE[NEEDED[state]]
        state = AFTER_S if role[:1] == "s" else THEN[state]
        out.append((letter, turn, role, text))
    return out, state


def fault_of(text: str) -> int:
    """Blank or truncated, by the text alone."""
    rest = text.rstrip(BLANKS)
    return BLANK if not rest else OK if rest[-1] in ".!?" else TRUNCATED


def initial_of(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "?"


def illegal_pairs(roles: list[str]) -> int:
    return sum((a[:1] + b[:1]) not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


def repair_one(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, messages) of
    one conversation's rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        fault = fault_of(text)
        if fault != BLANK and (role, text) in seen:
            fault = DUPLICATE
        seen.add((role, text))
        faults.append(fault)
    turns = {t for t, _, _ in rows if t is not None}
    ends = paths("".join(initial_of(r) for _, r, _ in rows), faults, NOTHING)
    best = min((ends[q] for q in (NOTHING, AFTER_A) if ends[q] is not None), key=lambda x: x[0])
    cost, audit = read_path(best, len(rows))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(BLANK), faults.count(DUPLICATE),
            faults.count(TRUNCATED), illegal_pairs([r for _, r, _ in rows]), cost, audit, replay(audit, NOTHING, rows)[0])


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _result_schema(rows: DataFrame) -> T.StructType:
    message = T.StructType([T.StructField("edit", T.StringType()), T.StructField("turn", T.LongType()),
                            T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("slice", T.LongType()),
                         T.StructField("slices", T.LongType()), *[T.StructField(c, T.LongType()) for c in COUNTS],
                         T.StructField("audit", T.StringType()), T.StructField("messages", T.ArrayType(message))])


_MESSAGES = pa.list_(pa.struct([("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))


def _result_batch(out: list[tuple], schema: T.StructType, id_kind: pa.DataType) -> pa.RecordBatch:
    """Rows (conv_id, slice, slices, counts..., audit, messages as tuples)."""
    cols = list(zip(*out))
    names = ("edit", "turn", "role", "text")
    kinds = [id_kind, *[pa.int64()] * 8, pa.string()]
    arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
    arrays.append(pa.array([[dict(zip(names, m)) for m in ms] for ms in cols[10]], _MESSAGES))
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


_ORDER = ["conv_id", "turn", "role", "text"]
#: Bytes of text after which a task hands on its results.
_BATCH = 2 << 20


def _ordinary(rows: DataFrame) -> DataFrame:
    schema = _result_schema(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, now, started = [], 0, [], False
        conv = kind = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for cid, turn, role, text, present in zip(*(batch.column(c).to_pylist() for c in [*_ORDER, "present"])):
                if started and cid != conv:
                    out.append((conv, 0, 1, *repair_one(now)))
                    now = []
                    if held > _BATCH or len(out) >= 8192:
                        yield _result_batch(out, schema, kind)
                        out, held = [], 0
                conv, started = cid, True
                if present:
                    now.append((turn, role, text))
                    held += len(text) + 64
        if started:
            out.append((conv, 0, 1, *repair_one(now)))
            yield _result_batch(out, schema, kind)

    dealt = rows.repartition("conv_id").sortWithinPartitions(*_ORDER)
    return dealt.select(*_ORDER, "present").mapInArrow(run, schema)


def _sliced(rows: DataFrame, slice_rows: int, slice_text: int) -> DataFrame:
    """Rows in order with (part, slice, pos), digest, initial and the fault that
    the text alone has; a slice is of one conversation."""
    id_type = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", id_type), T.StructField("part", T.IntegerType()),
                           T.StructField("slice", T.LongType()), T.StructField("pos", T.LongType()),
                           T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("initial", T.StringType()), T.StructField("fault", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pos, size, conv = -1, 0, 0, None
        for batch in batches:
            more = []
            for cid, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if number < 0 or cid != conv or pos >= slice_rows or size >= slice_text:
                    number, pos, size, conv = number + 1, 0, 0, cid
                digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
                more.append((number, pos, digest, initial_of(role), fault_of(text)))
                pos, size = pos + 1, size + len(text)
            if more:
                own = [pa.array(c, k) for c, k in zip(zip(*more), (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), own[0], own[1],
                                                  *(batch.column(c) for c in ("turn", "role", "text")), *own[2:]], names=schema.names)

    tie = F.monotonically_increasing_id()
    dealt = (rows.where("present").select(*_ORDER, tie.alias("tie"), F.substring("text", 1, 32).alias("head"))
             .repartitionByRange("conv_id", "turn", "role", "head", "tie").sortWithinPartitions(*_ORDER)
             .select(*_ORDER, F.spark_partition_id().alias("part")))
    return written(dealt.mapInArrow(run, schema), "turn-slices")


_SLICE = ["part", "slice"]


def _slice_paths(light: DataFrame) -> DataFrame:
    """The least path between any two states, for each slice."""
    id_type = light.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", id_type), T.StructField("part", T.IntegerType()),
                           T.StructField("slice", T.LongType()), T.StructField("initials", T.StringType()),
                           T.StructField("faults", T.ArrayType(T.LongType())), T.StructField("illegal", T.LongType()),
                           T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))])

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        initials, faults = "".join(group.column("initial").to_pylist()), group.column("fault").to_pylist()
        ends = [x for start in range(4) for x in paths(initials, faults, start)]
        read = [(None, None) if x is None else read_path(x, len(faults)) for x in ends]
        row = [[initials[0] + initials[-1]], [[faults.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)]],
               [illegal_pairs(list(initials))], [[c for c, _ in read]], [[a for _, a in read]]]
        kinds = (pa.string(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
        return pa.table([*(group.column(c).slice(0, 1) for c in ("conv_id", *_SLICE)),
                         *(pa.array(v, k) for v, k in zip(row, kinds))], names=schema.names)

    return light.groupBy(*_SLICE).applyInArrow(one, schema)


def chain(costs: list[list], audits: list[list]) -> tuple[int, list[tuple[int, str]]]:
    """The least path through consecutive slices: its cost and, for each slice,
    (state before it, letters)."""
    below = BITS * sum(max(len(a) for a in slice_ if a is not None) for slice_ in audits)
    unit = 1 << below
    at: list = [(0, below), None, None, None]
    back = []
    for cost, audit in zip(costs, audits):
        digits = [None if a is None else int(a.translate(_DIGITS) or "0", 8) for a in audit]
        new: list = [None] * 4
        come: list = [None] * 4
        for q in range(4):
            for p in range(4):
                if at[p] is None or audit[4 * p + q] is None:
                    continue
                weight, left = at[p]
                left -= BITS * len(audit[4 * p + q])
                weight += cost[4 * p + q] * unit + (digits[4 * p + q] << left)
                if new[q] is None or weight < new[q][0]:
                    new[q], come[q] = (weight, left), p
        at = new
        back.append(come)
    q = min((q for q in (NOTHING, AFTER_A) if at[q] is not None), key=lambda q: at[q][0])
    total, out = at[q][0] >> below, []
    for come, audit in zip(reversed(back), reversed(audits)):
        p = come[q]
        out.append((p, audit[4 * p + q]))
        q = p
    return total, out[::-1]


_DIGITS = str.maketrans(LETTERS, "1234")


def _chained(slices: DataFrame) -> DataFrame:
    """(part, slice, number, slices, state, audit, cost, blank, duplicate,
    truncated, illegal) for each slice of the least path."""
    names = ["part", "slice", "number", "slices", "state", "audit", "cost", "blank", "duplicate", "truncated", "illegal"]
    schema = T.StructType([T.StructField(n, {"part": T.IntegerType(), "audit": T.StringType()}.get(n, T.LongType())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held):
            total, steps = chain([h["costs"] for h in held], [h["audits"] for h in held])
            faults = [sum(x) for x in zip(*(h["faults"] for h in held))]
            illegal = sum(h["illegal"] for h in held) + sum(
                illegal_pairs([a["initials"][1], b["initials"][0]]) for a, b in zip(held, held[1:]))
            for i, (h, (state, audit)) in enumerate(zip(held, steps)):
                row = [h["part"], h["slice"], i, len(held), state, audit, total, *faults, illegal]
                yield pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=pa.schema(
                    [(f.name, {"part": pa.int32(), "audit": pa.string()}.get(f.name, pa.int64())) for f in schema]))

        held = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    yield from done(held)
                    held = []
                held.append(row)
        if held:
            yield from done(held)

    return written(slices.repartition("conv_id").sortWithinPartitions("conv_id", *_SLICE).mapInArrow(run, schema), "turn-chain")


def _large(rows: DataFrame, slice_rows: int, slice_text: int) -> DataFrame:
    schema = _result_schema(rows)
    cut = _sliced(rows, slice_rows, slice_text)
    at = ["part", "slice", "pos"]
    first = (cut.groupBy("conv_id", "digest").agg(F.min(F.struct(*at)).alias("_")).select("_.*", F.lit(True).alias("first")))
    light = (cut.select("conv_id", *at, "initial", "fault").join(first, at, "left")  # one row a key on both sides
             .withColumn("fault", F.when(F.col("first").isNull() & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault"))))
    chained = _chained(_slice_paths(light))
    gaps = cut.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    of = cut.select(F.col("conv_id").alias("_conv"), *_SLICE).distinct()
    gaps = gaps.withColumnRenamed("conv_id", "_of")
    plan = (chained.join(of, _SLICE).join(gaps, F.expr("_conv <=> _of")).drop("_of"))

    def one(key, group: pa.Table, chosen: pa.Table) -> pa.Table:
        kind = group.schema.field("conv_id").type
        group, step = group.sort_by("pos"), chosen.to_pylist()[0]
        turns = list(zip(*(group.column(c).to_pylist() for c in ("turn", "role", "text"))))
        messages, _ = replay(step["audit"], step["state"], turns)
        row = (step["_conv"], step["number"], step["slices"], *(step[c] for c in COUNTS), step["audit"], messages)
        return pa.Table.from_batches([_result_batch([row], schema, kind)])

    return (cut.select("conv_id", *at, "turn", "role", "text").groupBy(*_SLICE)
            .cogroup(plan.groupBy(*_SLICE)).applyInArrow(one, schema))


def repair(rows: DataFrame, slice_rows: int = SLICE_ROWS, slice_text: int = SLICE_TEXT) -> DataFrame:
    """Repaired conversations of rows (conv_id, turn, role, text and, if there
    is one, present); see the module's docstring for the result."""
    present = F.coalesce(F.col("present"), F.lit(False)) if "present" in rows.columns else F.lit(True)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], present.alias("present"))
    sizes = rows.groupBy("conv_id").agg(
        F.count_if("present").alias("n"), F.sum(F.when(F.col("present"), F.octet_length("text").cast("long"))).alias("b"))
    large = written(sizes.where((F.col("n") > slice_rows) | (F.col("b") > slice_text)).select("conv_id"), "turn-large")
    if large.isEmpty():
        return _ordinary(rows)
    same = F.expr("r.conv_id <=> l.conv_id")
    flagged = rows.alias("r").join(large.withColumn("large", F.lit(True)).alias("l"), same, "left").select("r.*", "l.large")
    small = _ordinary(flagged.where("large is null").drop("large"))
    return small.unionByName(_large(flagged.where("large").drop("large"), slice_rows, slice_text))


def as_text(messages: F.Column) -> F.Column:
    """``role:text`` lines of an array of messages."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")


def with_digest(repaired: DataFrame) -> DataFrame:
    """One row a conversation: counts, cost, the whole audit and the SHA-256 of
    its repaired text.  Conversations of one slice stay where they are; the
    slices of a larger one go in order through one running hash."""
    out = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    whole = (repaired.where("slices = 1").withColumn("repaired_sha256", F.sha2(as_text(F.col("messages")).cast("binary"), 256))
             .select(*out))
    sliced = repaired.where("slices > 1").withColumn("lines", F.when(F.size("messages") > 0, as_text(F.col("messages"))))
    sliced = sliced.select("conv_id", "slice", *COUNTS, "audit", "lines")
    id_type = repaired.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", id_type), *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row():
            kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            values = [now["conv_id"], *(now[c] for c in COUNTS), "".join(audit), digest.hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=schema.names)

        now = kind = digest = None
        audit, any_line = [], False
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if now is None or r["conv_id"] != now["conv_id"]:
                    if now is not None:
                        yield row()
                    now, digest, audit, any_line = r, hashlib.sha256(), [], False
                audit.append(r["audit"])
                if r["lines"] is not None:
                    digest.update((("\n" if any_line else "") + r["lines"]).encode())
                    any_line = True
        if now is not None:
            yield row()

    return whole.unionByName(sliced.repartition("conv_id").sortWithinPartitions("conv_id", "slice").mapInArrow(run, schema))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32("conv_id:turn") mod 20 (nulls: one blank): 0 drops
    the row (``present`` is false), 1 empties its text, 2 removes ``.!?``, 3
    repeats it, 4 sets its role to user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    rows = rows.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                       .otherwise(F.col("text")).alias("text"), (F.col("kind") != 0).alias("present"))
