"""SimHash near-duplicates by a binary-trie self-join.

Fingerprint (64 bits): A-Z are lower-cased, words are runs without ASCII white
space, shingles are three words joined by a space (repeats included; fewer
words: the whole sequence).  A bit is 1 if it is set in over half of the
shingles' XXH64 (seed 42).  No words: zero.

Links: two fingerprints link at ``max_bits`` (2) or fewer differing bits.  The
join runs over *distinct* fingerprints, so exact copies never multiply.

* Two fingerprints that differ in at most k bits agree on one of k + 1 blocks
  of bits.  Each block gives a family of trie roots: one root for each block
  value, below which the whole remaining error budget is left.  A fingerprint
  goes to k + 1 roots whatever the size of the corpus.
* A root with more than ``LIMIT`` fingerprints is split into node pairs: on
  its most balanced free bits, a fingerprint goes to the pairs of children
  that differ in no more bits than the budget allows.  This repeats until
  every node pair is small; the driver sees only how many are not.
* Within a task, node pairs are traversed together from the top bit, with the
  differing bits accumulated; a pair beyond the budget is dropped with all
  below it, and small pairs are compared leaf by leaf.  A task returns its
  links as stars (fingerprint, smallest one reached), never as all pairs.

Components of the stars are found by ``components.py``; component_id is the
smallest doc_id of the component.

Defined results: null text has no words.  Rows with a null doc_id are linked
like others but never name a component unless all its ids are null (then
component_id is null).  Repeated rows each get their row; ``dedup`` keeps one
row of each component: that of the smallest doc_id, ties by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import append_columns, set_aside, written
from mercato.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Most fingerprints below one node pair that a task traverses.
LIMIT = 40_000
#: Fingerprints that a task gets on average.
PER_TASK = 100_000
#: Bits on which a large node pair is split at once.
SPLIT_BITS = 4
#: Pairs of leaves up to which a node pair is compared directly.
DIRECT = 32
FRONTIER = 1 << 18

#: Columns of near_duplicates.
MADE = ("fp", "component_id", "root", "_row")

_POP = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


def shingle_hashes(text: str | None, k: int = SHINGLE) -> np.ndarray:
    w = text.encode().lower().split() if text else []
    if not w:
        return np.zeros(0, dtype=">u8")
    h = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(w[i:] for i in range(k)))) if len(w) >= k else [b" ".join(w)]
    return np.array([h(g, SEED) for g in grams], dtype=">u8")


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    h = shingle_hashes(text, k)
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[a:a + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint ``fp`` (a signed long)."""
    def make():
        return lambda texts: [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]

    return append_columns(docs, make, [T.StructField("fp", T.LongType(), False)], keep=keep)


# --- the join -------------------------------------------------------------

def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = np.ascontiguousarray(a ^ b).view(np.uint16).reshape(-1, 4)
    return _POP[x].sum(axis=1, dtype=np.int64)


class _Sets:
    """Union-find over row numbers, a batch of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def union(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.root[u], self.root[v]
            differ = a != b
            if not differ.any():
                return
            u, v, a, b = u[differ], v[differ], a[differ], b[differ]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _direct(fp, lo1, n1, lo2, n2, own, bits, sets) -> None:
    size = n1 * n2
    for a in range(0, len(size), FRONTIER // DIRECT):
        s = slice(a, a + FRONTIER // DIRECT)
        node = np.repeat(np.arange(len(size[s])), size[s])
        k = np.arange(len(node)) - np.repeat(np.cumsum(size[s]) - size[s], size[s])
        i = lo1[s][node] + k // n2[s][node]
        j = lo2[s][node] + k % n2[s][node]
        ok = ~own[s][node] | (i < j)
        i, j = i[ok], j[ok]
        near = distance(fp[i], fp[j]) <= bits
        sets.union(i[near], j[near])


def trie_join(task: np.ndarray, side: np.ndarray, fp: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Stars (fingerprint, root) of the links inside each task: within side 0
    if the task has one side, else between its sides.  ``fp`` is uint64."""
    order = np.lexsort((fp, side, task))
    task, side, fp = task[order], side[order], fp[order]
    n = len(fp)
    sets = _Sets(n)
    cut = np.flatnonzero(np.r_[True, (task[1:] != task[:-1]) | (side[1:] != side[:-1])]) if n else np.zeros(0, int)
    end = np.r_[cut[1:], n] if n else cut
    two = np.flatnonzero(task[cut[1:]] == task[cut[:-1]]) if len(cut) > 1 else np.zeros(0, int)
    paired = np.zeros(len(cut), dtype=bool)
    paired[two] = paired[two + 1] = True
    alone = np.flatnonzero(~paired & (side[cut] == 0)) if n else cut
    lo1, hi1 = np.r_[cut[alone], cut[two]], np.r_[end[alone], end[two]]
    lo2, hi2 = np.r_[cut[alone], cut[two + 1]], np.r_[end[alone], end[two + 1]]
    ones = {}
    stack = [(63, lo1, hi1, lo2, hi2, np.zeros(len(lo1), dtype=np.int64))]
    while stack:
        bit, lo1, hi1, lo2, hi2, err = stack.pop()
        own = lo1 == lo2
        n1, n2 = hi1 - lo1, hi2 - lo2
        small = n1 * n2 <= DIRECT
        if bit < 0:
            small[:] = True  # distinct values: only single leaves are left
        if small.any():
            _direct(fp, lo1[small], n1[small], lo2[small], n2[small], own[small], bits, sets)
            lo1, hi1, lo2, hi2, err, own = (x[~small] for x in (lo1, hi1, lo2, hi2, err, own))
        if not len(lo1):
            continue
        if bit not in ones:
            ones[bit] = np.r_[0, np.cumsum((fp >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)]
        c = ones[bit]
        m1, m2 = hi1 - (c[hi1] - c[lo1]), hi2 - (c[hi2] - c[lo2])
        z = own, err
        parts = [(lo1, m1, lo2, m2, err, slice(None)), (m1, hi1, m2, hi2, err, slice(None)),
                 (lo1, m1, m2, hi2, err + 1, slice(None)), (m1, hi1, lo2, m2, err + 1, ~z[0])]
        cols = [np.concatenate([p[i][p[5]] for p in parts]) for i in range(5)]
        live = (cols[0] < cols[1]) & (cols[2] < cols[3]) & (cols[4] <= bits)
        cols = [x[live] for x in cols]
        for a in range(0, len(cols[0]), FRONTIER):
            stack.append((bit - 1, *(x[a:a + FRONTIER] for x in cols)))
    linked = np.flatnonzero(sets.root != np.arange(n))
    return fp[linked], fp[sets.root[linked]]


def _blocks(bits: int) -> list[tuple[int, int]]:
    """(shift, mask) of bits + 1 blocks that cover 64 bits."""
    edges = [64 * i // (bits + 1) for i in range(bits + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def node_pairs(fps: DataFrame, bits: int = MAX_BITS, limit: int = LIMIT) -> DataFrame:
    """(task, side, fp): node pairs with at most ``limit`` fingerprints each
    that between them hold every pair within ``bits``."""
    roots = F.array(*[F.struct(F.concat_ws(":", F.lit(str(i)), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit(m)).cast("string")).alias("task"),
                               F.lit(_signed(m << a)).alias("used")) for i, (a, m) in enumerate(_blocks(bits))])
    state = (fps.select("fp", F.explode(roots).alias("r"))
             .select("r.task", F.lit(0).alias("side"), "fp", F.lit(bits).alias("budget"), "r.used", F.lit(False).alias("cross")))
    done = None
    while True:
        large = state.groupBy("task").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        if large.isEmpty():
            return state.select("task", "side", "fp") if done is None else done.unionByName(state.select("task", "side", "fp"))
        large = written(large, "large-nodes")
        rest = state.join(large, "task", "left_anti").select("task", "side", "fp")
        done = rest if done is None else done.unionByName(rest)
        hot = state.join(large.select("task"), "task", "left_semi")
        share = hot.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.first("used").alias("u"), *[
            F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(64)])
        order = F.array_sort(F.filter(F.array(*[
            F.struct(F.abs(2 * F.col(f"b{i}") - F.col("n")).alias("off"), F.lit(i).alias("bit"),
                     F.shiftrightunsigned("u", i).bitwiseAND(F.lit(1)).alias("taken")) for i in range(64)]),
            lambda x: x["taken"] == 0))
        chosen = share.select("task", F.slice(F.transform(order, lambda x: x["bit"]), 1, SPLIT_BITS).alias("bits"))
        hot = hot.join(chosen, "task")
        code = F.aggregate("bits", F.lit(0).cast("long"), lambda acc, b: acc * 2 + F.expr("1L").bitwiseAND(F.call_function("shiftrightunsigned", F.col("fp"), b)))
        mask = F.aggregate("bits", F.col("used"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", F.expr("1L"), b)))
        hot = hot.withColumns({"code": code, "used2": mask})
        partners = F.filter(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, size(bits)) - 1")),
                            lambda d: F.bit_count(d.bitwiseXOR(F.col("code"))) <= F.col("budget"))
        hot = hot.withColumn("d", F.explode(partners))
        low = F.when(F.col("cross"), F.when(F.col("side") == 0, F.col("code")).otherwise(F.col("d"))).otherwise(F.least("code", "d"))
        high = F.when(F.col("cross"), F.when(F.col("side") == 0, F.col("d")).otherwise(F.col("code"))).otherwise(F.greatest("code", "d"))
        state = written(hot.select(
            F.concat_ws("/", "task", F.concat_ws("-", low.cast("string"), high.cast("string"))).alias("task"),
            F.when(F.col("cross"), F.col("side")).otherwise((F.col("code") > F.col("d")).cast("int")).alias("side"), "fp",
            (F.col("budget") - F.bit_count(F.col("code").bitwiseXOR(F.col("d")))).alias("budget"),
            F.col("used2").alias("used"), (F.col("cross") | (F.col("code") != F.col("d"))).alias("cross")), "node-pairs")


def links(fps: DataFrame, bits: int = MAX_BITS, limit: int = LIMIT) -> DataFrame:
    """Links (u, v) whose components are those of all pairs within ``bits``;
    ``fps`` has the distinct fingerprints in its column fp."""
    n = fps.count()
    tasks = max(1, -(-n * (bits + 1) // PER_TASK))
    pairs = node_pairs(fps, bits, limit).withColumn("part", F.pmod(F.xxhash64("task"), F.lit(tasks)))

    def join(table: pa.Table) -> pa.Table:
        task = table.column("task").combine_chunks().dictionary_encode()
        task = task.indices if isinstance(task, pa.DictionaryArray) else task.combine_chunks().indices
        u, v = trie_join(task.to_numpy(zero_copy_only=False), table.column("side").to_numpy(),
                         table.column("fp").to_numpy().view(np.uint64), bits)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return pairs.groupBy("part").applyInArrow(join, "u long, v long")


def _components(docs: DataFrame, keep: list[str], shingle: int, bits: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows (columns ``keep``, doc_id, fp, _row), written, and (fp, component_id,
    root) of each fingerprint."""
    rows = written(with_fingerprints(docs, [*dict.fromkeys([*keep, "doc_id"])], shingle)
                   .withColumn("_row", F.monotonically_increasing_id()), "fingerprints")
    first = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(first.select("fp"), bits, limit))
    named = first.join(roots, first["fp"] == roots["u"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows, named.join(ids, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, keep: list[str] | None = None, shingle: int = SHINGLE,
                    bits: int = MAX_BITS, limit: int = LIMIT) -> DataFrame:
    """``docs`` (columns ``keep``) with fp, component_id, root (its smallest
    fingerprint) and ``_row``, a row number that is unique and stays the same."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in MADE]
    rows, of_fp = _components(docs, keep, shingle, bits, limit)
    return rows.join(of_fp, "fp").select(*keep, "fp", "component_id", "root", "_row", *([] if "doc_id" in keep else ["doc_id"]))


def dedup(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: that of the smallest doc_id.  The rows that
    stay are found by number; whole rows are joined once."""
    def first_rows(d: DataFrame) -> DataFrame:
        rows, of_fp = _components(d, [c for c in d.columns if c not in MADE], shingle, bits, LIMIT)
        narrow = rows.select("fp", "doc_id", "_row").join(of_fp.select("fp", "root"), "fp")
        stay = narrow.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("k"))
        return rows.join(stay.select(F.col("k._row").alias("_row")), "_row", "left_semi")

    return set_aside(docs, list(MADE), first_rows)


def hex_of(col) -> F.Column:
    return F.lower(F.lpad(F.hex(col), 16, "0"))
