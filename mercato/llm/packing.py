"""Packing of token sequences by the linear grouping scheme.

A document's ids, with an end id, go to sequences of at most ``limit`` tokens;
only longer documents are cut.  Bin packing depends on lengths alone, and there
are no more than ``limit`` of them, so the plan is made on the driver from the
histogram of lengths, at a cost that does not grow with the data:

1. lengths over a share of ``limit`` are sorted and cut into groups of equal
   cardinality; each is rounded up to the largest of its group;
2. for these few sizes the configuration linear program is solved by column
   generation (a knapsack prices new configurations); its whole numbers are
   used, and the few documents left over go with step 4;
3. actual documents take the places of their group, so sequences keep the room
   that rounding had set aside;
4. the rest goes by best fit, longest first, into the fullest sequence that
   has room, else into new ones;
5. of the plans for a few shares and numbers of groups (``TRIED``), that of
   the fewest sequences is used.

Runs of equal documents are placed at once, so the plan is a list of ranges
(length, ranks) -> (sequences, offset).  Its size depends on the number of
lengths, not of documents (a few tens of thousand ranges for 2048), so it is
broadcast.  A document's rank within its length is numbered per written part,
and the parts' totals are summed up by a window for each length.

Defined results: null or empty text is a document of the end id alone.  Rows
with equal or null doc_id are packed like others.  An empty table gives no
pieces.  A carried column with a name of the result gives way.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm import bpe
from mercato.llm.common import Payload, slices, written

LIMIT = 2048
END_ID = 0
#: (s, groups): lengths over limit / s are large.  Rounding costs most where
#: short documents could fill exactly, so the best share depends on the data.
TRIED = ((2, 64), (3, 128), (4, 64), (8, 64))
#: Most columns that the linear program may generate.
COLUMNS = 2000


# --- the plan, on a histogram of lengths ------------------------------------

def _knapsack(sizes: np.ndarray, value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of sizes that fits."""
    best, took = np.zeros(room + 1), []
    for _ in range(room // int(sizes.min())):  # one more place each time
        v = np.full((len(sizes), room + 1), -1.0)
        for i, s in enumerate(sizes.tolist()):
            v[i, s:] = best[:room + 1 - s] + value[i]
        i = v.argmax(axis=0)
        v = v[i, np.arange(room + 1)]
        took.append(np.where(v > best, i, -1))
        best = np.maximum(v, best)
    count = np.zeros(len(sizes), dtype=np.int64)
    c = room
    for t in reversed(took):
        if t[c] >= 0:
            count[t[c]] += 1
            c -= int(sizes[t[c]])
    return float(best[room]), count


def configurations(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Configurations (places for each size) and how often to use each: the
    whole parts of a solution of the configuration linear program."""
    n = len(sizes)
    if not n:
        return []
    basis = np.diag(np.maximum(room // sizes, 1)).astype(float)  # a column each
    for _ in range(COLUMNS):
        x = np.linalg.solve(basis, demand.astype(float))
        price = np.linalg.solve(basis.T, np.ones(n))
        worth, column = _knapsack(sizes, price, room)
        if worth <= 1 + 1e-7:
            break
        d = np.linalg.solve(basis, column.astype(float))
        ok = d > 1e-9
        ratio = np.full(n, np.inf)
        ratio[ok] = np.maximum(x[ok], 0) / d[ok]
        basis[:, int(ratio.argmin())] = column
    x = np.linalg.solve(basis, demand.astype(float))
    return [(basis[:, j].astype(np.int64), int(np.floor(x[j] + 1e-9))) for j in range(n) if x[j] >= 1 - 1e-9]


class _Runs:
    """A queue of equal lengths with their ranks: (length, first rank, count)."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        self.runs = list(reversed(runs))

    def take(self, n: int) -> tuple[int, int, int] | None:
        """Up to n documents of one length."""
        if not self.runs:
            return None
        length, rank, count = self.runs.pop()
        if count > n:
            self.runs.append((length, rank + n, count - n))
        return length, rank, min(n, count)


def plan(histogram: dict[int, int], limit: int = LIMIT) -> tuple[np.ndarray, int]:
    """The plan of fewest sequences over the shares and numbers of groups tried."""
    return min((grouped(histogram, limit, small, groups) for small, groups in TRIED), key=lambda p: p[1])


def grouped(histogram: dict[int, int], limit: int, small: int, groups: int) -> tuple[np.ndarray, int]:
    """(ranges, number of sequences).  A range is (length, first rank, count,
    first sequence, places in each sequence, offset of the first place)."""
    ranges: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free -> (first sequence, count)
    used = 0
    large = [(n, 0, histogram[n]) for n in sorted(histogram, reverse=True) if n * small > limit]
    total = sum(r[2] for r in large)
    per = max(1, -(-total // groups))
    queues, sizes, demand = [], [], []
    rest = _Runs(large)
    while rest.runs:
        part, need = [], per
        while need and (got := rest.take(need)):
            part.append(got)
            need -= got[2]
        queues.append(_Runs(part))
        sizes.append(part[0][0])
        demand.append(sum(p[2] for p in part))
    # equal sizes are one size of the program
    of_size: dict[int, list[int]] = defaultdict(list)
    for g, s in enumerate(sizes):
        of_size[s].append(g)
    uniq = sorted(of_size, reverse=True)
    queue = [_Runs([r for g in of_size[s] for r in reversed(queues[g].runs)]) for s in uniq]
    need = np.array([sum(demand[g] for g in of_size[s]) for s in uniq], dtype=np.int64)
    for places, often in configurations(np.array(uniq, dtype=np.int64), need, limit):
        # sequences used .. used + often - 1; equal stretches stay together
        open_ = [(used, often, 0)]
        used += often
        for g in np.repeat(np.arange(len(uniq)), places):
            after = []
            for first, count, fill in open_:
                while count:
                    got = queue[g].take(count)
                    if got is None:
                        after.append((first, count, fill))
                        break
                    length, rank, n = got
                    ranges.append((length, rank, n, first, 1, fill))
                    after.append((first, n, fill + length))
                    first, count = first + n, count - n
            open_ = after
        for first, count, fill in open_:
            room[limit - fill].append((first, count))
    # best fit, longest first: what the whole numbers left over, then the small
    left = [r for q in queue for r in reversed(q.runs)] + [(n, 0, histogram[n]) for n in histogram if n * small <= limit]
    free = np.zeros(limit + 1, dtype=bool)
    for r in room:
        free[r] = r > 0
    for length, rank, count in sorted(left, reverse=True):
        while count:
            fit = np.flatnonzero(free[length:])
            if len(fit):
                r = length + int(fit[0])
                first, bins = room[r].pop()
                if not room[r]:
                    free[r] = False
            else:
                r, first, bins = limit, used, -(-count // (limit // length))
                used += bins
            each = r // length
            whole = min(bins, count // each)
            if whole:
                ranges.append((length, rank, whole * each, first, each, limit - r))
                room[r - each * length].append((first, whole))
                free[r - each * length] = r > each * length
                rank, count, first, bins = rank + whole * each, count - whole * each, first + whole, bins - whole
            if count and bins:  # fewer than a sequence takes
                ranges.append((length, rank, count, first, each, limit - r))
                room[r - count * length].append((first, 1))
                free[r - count * length] = r > count * length
                count, first, bins = 0, first + 1, bins - 1
            if bins:
                room[r].append((first, bins))
                free[r] = True
    out = np.array(sorted(ranges), dtype=np.int64).reshape(-1, 6)
    return out, used


# --- the job --------------------------------------------------------------

def pieces(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, rank): the pieces of every
    document, written; ``ids`` are little-endian 32-bit numbers, ``rank``
    counts the pieces of equal length within a written part."""
    definition = bpe.sent(docs.sparkSession, path)

    def run(batches):
        encoder = bpe.encoder(definition.get())
        part_id = TaskContext.get().partitionId()
        seen: Counter = Counter()
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for part in slices(batch, "text"):
                got = encoder.encode(part.column("text").to_pylist())
                row, piece, start, length, rank, blobs = [], [], [], [], [], []
                for i, ids in enumerate(got):
                    ids = np.concatenate([ids, end])
                    for k, a in enumerate(range(0, len(ids), limit)):
                        p = ids[a:a + limit]
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(len(p))
                        rank.append(seen[len(p)])
                        seen[len(p)] += 1
                        blobs.append(p.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(blobs, pa.binary()),
                     pa.array(np.full(len(row), part_id, dtype=np.int32)), pa.array(rank, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "rank"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids binary, part int, rank long"), "pieces")


def pack(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length,
    ids, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, limit, end_id, path)
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = (Window.partitionBy("length").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges, _ = plan(histogram, limit)
    sent = Payload(docs.sparkSession, ranges)
    placed = (cut.withColumn("ids_crc32", F.crc32("ids")).join(base, ["part", "length"])
              .withColumn("rank", F.col("rank") + F.col("base")).drop("base", "part"))
    return placed.withColumn("_at", _places(sent)("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32", "_at.sequence_id", "_at.offset")


def _places(sent: Payload):
    @F.pandas_udf("sequence_id long, offset long")
    def places(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        ranges = sent.get()
        key = ranges[:, 0] << 48 | ranges[:, 1]
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        r = ranges[np.searchsorted(key, length << 48 | rank, side="right") - 1]
        k = rank - r[:, 1]
        return pd.DataFrame({"sequence_id": r[:, 3] + k // r[:, 4], "offset": r[:, 5] + k % r[:, 4] * length})

    return places
