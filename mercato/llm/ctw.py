"""Language-model scores by context-tree weighting over bytes.

A text is the byte stream of its tokens (A-Z lower-cased, split at ASCII white
space), each followed by a space, and one end byte.  A byte is coded as its 8
bits (binary decomposition): each of the 255 places in the bit tree has its
own tree of contexts, the last 0 .. ``DEPTH`` bytes.  Every node holds a
Krichevsky-Trofimov estimate of its bit counts, and a node above the deepest
level weights its own estimate and the product of its children's half and
half.  The score of a text is the log10 probability that the mixture over all
depths, with the counts of the training texts, gives its stream; contexts do
not go over the start of a text.

Only the distinct grams (context and byte) matter, so the work is theirs:

1. One map cuts the texts into chunks and writes each chunk's streams
   (compressed), its distinct grams with their training counts, and its
   distinct words with theirs; grams are dealt to buckets by the last two
   context bytes, words by a hash.
2. A bucket holds whole subtrees from depth 2 down.  One task a bucket sums the
   counts of all chunks, weights its subtrees bottom-up, and mixes each gram's
   prediction up to depth 2, some subtrees from depth 3 at a time and a bit place
   at a time, so that a gram takes its key, count and predictions.  The two top levels have at most 256 x 255 nodes
   whatever the corpus; they are summed by a groupBy and broadcast.
3. A second pass over the buckets finishes the grams' predictions and returns
   to each chunk those of its own grams; words' counts go the same way.
4. Each chunk's texts are scored from its own grams and words.

What is shuffled is the distinct grams and words of chunks, and the streams
once; nothing is collected but the top levels and three totals.

The base score is that of a unigram model with 0.1 added to each count.

Defined results: null text is empty: its stream is the end byte, its tokens
the end.  A null doc_id counts as the empty text in the held-out rule.
Without training texts every bit has probability 1/2, and the base score is 0.
Repeated rows each get their row (and train the model as often).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import Payload, crc32_of_id, input_bytes, slices, written

DEPTH = 5
CHUNK_BYTES = 20 << 20
#: Buckets at least and at most, and bytes of input that make one more.  A
#: bucket holds the grams of whole two-byte contexts, so the largest such context
#: (some hundredths of all grams) bounds what more buckets can do.
BUCKETS, MOST_BUCKETS, BUCKET_BYTES = 128, 4096, 16 << 20
#: Bytes of a stream that one step handles.
WINDOW = 1 << 20
#: Grams that one step of a bucket handles at once (whole subtrees from depth 3).
STEP_GRAMS = 1 << 18
PAD, END, SPACE = 0x0B, 0x0A, 0x20  # no token has a pad or an end byte

_HALF = math.log(0.5)


# --- byte streams and grams ---------------------------------------------------

def stream(text: str | None) -> bytes:
    """Pads, the tokens with a space after each, and the end."""
    words = text.encode().lower().split() if text else []
    return b"\x0b" * DEPTH + b"".join(w + b" " for w in words) + b"\n"


def grams(stream_bytes: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Keys of the positions start .. stop-1: the context's bytes, the last
    one highest, and the byte itself lowest.  start must be DEPTH or more."""
    key = stream_bytes[start:stop].astype(np.uint64)
    for j in range(1, DEPTH + 1):
        key |= stream_bytes[start - j:stop - j].astype(np.uint64) << np.uint64(8 * (DEPTH - j + 1))
    return key


def windows(streams: bytes):
    """(keys, bytes) of the scored positions, a window at a time."""
    b = np.frombuffer(streams, dtype=np.uint8)
    for start in range(DEPTH, len(b), WINDOW):
        stop = min(start + WINDOW, len(b))
        scored = b[start:stop] != PAD
        yield grams(b, start, stop)[scored], b[start:stop][scored]


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


class Sums:
    """Distinct keys with the sums of their numbers, of many parts: holds those
    so far and about as many more."""

    def __init__(self, at_once: int = 1 << 20):
        self.keys, self.n, self.at_once = np.zeros(0, np.uint64), np.zeros(0, np.int64), at_once
        self.held, self.size = [], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.held.append((keys, n))
        self.size += len(keys)
        if self.size >= max(self.at_once, len(self.keys)):
            self.get()

    def get(self) -> tuple[np.ndarray, np.ndarray]:
        if self.held:
            keys, n = (np.concatenate(x) for x in zip((self.keys, self.n), *self.held))
            self.held, self.size = [], 0
            self.keys, self.n = summed(keys, n)
        return self.keys, self.n


def bucket_of(keys: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    two = keys >> np.uint64(8 * DEPTH - 8)  # the last two context bytes
    return ((two * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets


def _pack(x: np.ndarray) -> bytes:
    """A compressed array; bytes of equal weight lie together."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw).data)


def _unpack(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    b = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    return np.ascontiguousarray(b.reshape(kind.itemsize, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


# --- the tree -------------------------------------------------------------------

def _log_gamma_table(shift: float) -> np.ndarray:
    return np.array([math.lgamma(i + shift) for i in range(64)])


_SMALL = {0.5: _log_gamma_table(0.5), 1.0: _log_gamma_table(1.0)}


def log_gamma(n: np.ndarray, shift: float) -> np.ndarray:
    """log gamma(n + shift) of whole numbers n, shift 0.5 or 1."""
    x = n + shift
    big = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5)
    return np.where(n < 64, _SMALL[shift][np.minimum(n, 63).astype(np.int64)], big)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0, 0.5) + log_gamma(n1, 0.5) - log_gamma(n0 + n1, 1.0) - math.log(math.pi)


def mixed(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.logaddexp(own + _HALF, below + _HALF)


class _Nodes:
    """The nodes of a level at one bit place: each gram's node, the nodes' first
    grams, the grams' bits, and the nodes' zeros and ones."""

    def __init__(self, level: _Level, k: int):
        prefix = level.byte >> np.uint8(8 - k) if k else np.zeros_like(level.byte)
        new = np.r_[True, level.new | (prefix[1:] != prefix[:-1])]
        self.first = np.flatnonzero(new)
        self.place = np.cumsum(new) - 1
        self.bit = (level.byte >> np.uint8(7 - k)) & np.uint8(1)
        self.n1 = np.add.reduceat(level.n * self.bit, self.first)
        self.n0 = np.add.reduceat(level.n, self.first) - self.n1

    def estimate(self) -> np.ndarray:
        """The KT probability of each gram's own bit."""
        at = self.place
        return (np.where(self.bit == 1, self.n1[at], self.n0[at]) + 0.5) / (self.n0 + self.n1 + 1)[at]


class _Level:
    """Grams of one depth: sorted (context, byte) keys and counts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n
        self.byte = (keys & np.uint64(255)).astype(np.uint8)
        self.new = (keys[1:] >> np.uint64(8)) != (keys[:-1] >> np.uint64(8))

    def shorter(self) -> tuple[_Level, np.ndarray]:
        """The level above, and each gram's place in it."""
        # the context's oldest byte is the lowest one above the gram's byte
        k, to = np.unique((self.keys >> np.uint64(16) << np.uint64(8)) | (self.keys & np.uint64(255)), return_inverse=True)
        return _Level(k, np.bincount(to, weights=self.n, minlength=len(k))), to


def _raised(low: _Nodes, weighted: np.ndarray, here: _Nodes, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From a level to the one above: its nodes' weighted log probabilities, and
    the share of their own estimates."""
    # a child node's first gram shows which node is above it
    below = np.bincount(here.place[up[low.first]], weights=weighted, minlength=len(here.first))
    own = log_kt(here.n0, here.n1)
    weighted = mixed(own, below)
    return weighted, np.exp(own + _HALF - weighted)


def _mix(p: np.ndarray, k: int, here: _Nodes, share: np.ndarray, to: np.ndarray) -> None:
    share = share[here.place][to]
    p[:, k] = share * here.estimate()[to] + (1 - share) * p[:, k]


def _branches(keys: np.ndarray, n: np.ndarray, p: np.ndarray, top: int) -> tuple[_Level, np.ndarray, list[np.ndarray]]:
    """Predictions of whole subtrees' grams into ``p``, mixed from depth DEPTH up
    to ``top``; the grams of depth top, each gram's place among them, and for
    each bit place the weighted log probabilities of the nodes of depth top."""
    levels, up = [_Level(keys, n)], []
    for _ in range(DEPTH, top, -1):
        above, to = levels[-1].shorter()
        levels.append(above)
        up.append(to)
    roots = []
    for k in range(8):
        low = _Nodes(levels[0], k)
        p[:, k] = low.estimate()
        weighted = log_kt(low.n0, low.n1)
        to = np.arange(len(keys))  # from grams to this level's
        for i, level in enumerate(levels[1:]):
            here, to = _Nodes(level, k), up[i][to]
            weighted, share = _raised(low, weighted, here, up[i])
            _mix(p, k, here, share, to)
            low = here
        roots.append(weighted)
    return levels[-1], to, roots


def _steps(keys: np.ndarray, depth: int, size: int) -> list[slice]:
    """Slices of about ``size`` grams that hold whole contexts of ``depth`` bytes."""
    context = keys >> np.uint64(8 * (DEPTH + 1 - depth))
    stops = np.append(np.flatnonzero(context[1:] != context[:-1]) + 1, len(keys))
    out, at = [], 0
    while at < len(keys):
        i = max(np.searchsorted(stops, at + size, side="right") - 1, np.searchsorted(stops, at, side="right"))
        out.append(slice(at, int(stops[i])))
        at = int(stops[i])
    return out


def subtrees(keys: np.ndarray, n: np.ndarray, top: int = 2, step: int = STEP_GRAMS):
    """Predictions of every gram's 8 bits, mixed from depth DEPTH up to
    ``top``, and the sums that the level above needs: (context of top - 1
    bytes, bit place, zeros, ones, log of the children's product)."""
    p, place = np.empty((len(keys), 8)), np.empty(len(keys), np.int32)
    steps, parts, found = _steps(keys, top + 1, step), [], 0
    for s in steps:
        level, to, roots = _branches(keys[s], n[s].astype(np.float64), p[s], top + 1)
        place[s] = to + found
        found += len(level.keys)
        parts.append((level.keys, level.n, roots))
    lower = _Level(np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]))
    last, up = lower.shorter()
    sums = []
    for k in range(8):
        here = _Nodes(last, k)
        weighted, share = _raised(_Nodes(lower, k), np.concatenate([x[2][k] for x in parts]), here, up)
        for s in steps:
            _mix(p[s], k, here, share, up[place[s]])
        first = here.first
        context = (last.keys[first] >> np.uint64(8)) >> np.uint64(8)
        at = (1 << k) | ((last.keys[first] & np.uint64(255)).astype(np.int64) >> (8 - k))
        where, to = np.unique(context.astype(np.int64) << 8 | at, return_inverse=True)
        sums.append(np.stack([where.astype(np.float64), *(np.bincount(to, weights=x, minlength=len(where)) for x in (here.n0, here.n1, weighted))], axis=1))
    return p, np.concatenate(sums)


class Top:
    """The two top levels: one context byte, and none."""

    def __init__(self, where: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray):
        own = log_kt(n0, n1)
        weighted = mixed(own, below)
        self.share1, self.one1 = np.full(1 << 16, 0.5), np.full(1 << 16, 0.5)
        self.share1[where] = np.exp(own + _HALF - weighted)
        self.one1[where] = (n1 + 0.5) / (n0 + n1 + 1)
        place = where & 255
        n0, n1, below = (np.bincount(place, weights=x, minlength=256) for x in (n0, n1, weighted))
        own = log_kt(n0, n1)
        self.share0 = np.exp(own + _HALF - mixed(own, below))
        self.one0 = (n1 + 0.5) / (n0 + n1 + 1)

    def log10(self, keys: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Log10 probability of every gram's byte, from its predictions at depth 2."""
        byte = (keys & np.uint64(255)).astype(np.int64)
        context = (keys >> np.uint64(8 * DEPTH)).astype(np.int64)
        out = np.zeros(len(keys))
        for k in range(8):
            place = (1 << k) | (byte >> (8 - k))
            one = (byte >> (7 - k)) & 1 == 1
            at = context << 8 | place
            q1 = np.where(one, self.one1[at], 1 - self.one1[at])
            q0 = np.where(one, self.one0[place], 1 - self.one0[place])
            x = self.share1[at] * q1 + (1 - self.share1[at]) * p[:, k]
            out += np.log10(self.share0[place] * q0 + (1 - self.share0[place]) * x)
        return out


class Lookup:
    """Values of distinct keys, found by two hash tables and a short rest."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.tables, left = [], np.arange(len(keys))
        for turn in range(2):
            table = np.zeros(1 << self.bits, dtype=np.int32)
            slot = self._slot(keys[left], turn)
            table[slot] = left
            left = left[table[slot] != left]
            self.tables.append(table)
        order = np.argsort(keys[left])
        self.rest = left[order]

    def _slot(self, keys: np.ndarray, turn: int) -> np.ndarray:
        c = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[turn]
        return ((keys * np.uint64(c)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all known."""
        at = self.tables[0][self._slot(keys, 0)]
        miss = np.flatnonzero(self.keys[at] != keys)
        if len(miss):
            at[miss] = self.tables[1][self._slot(keys[miss], 1)]
            miss = miss[self.keys[at[miss]] != keys[miss]]
            if len(miss):
                at[miss] = self.rest[np.searchsorted(self.keys[self.rest], keys[miss])]
        return self.values[at]


# --- the jobs -----------------------------------------------------------------------

CHUNKS = "chunk long, kind int, bucket int, ids array<{id}>, held array<boolean>, a binary, b binary"
STREAMS, GRAMS, WORDS = 0, 1, 2


def _rows(chunk: int, id_type: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    kind, bucket, ids, held, a, b = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * len(rows), pa.int64()), pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(ids, pa.list_(id_type)),
         pa.array(held, pa.list_(pa.bool_())), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
        names=["chunk", "kind", "bucket", "ids", "held", "a", "b"])


def chunks(docs: DataFrame, held_out: F.Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Step 1: written rows of chunks' streams, grams and words."""
    src = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    buckets = min(max(BUCKETS, -(-input_bytes(docs) // BUCKET_BYTES)), MOST_BUCKETS)

    def run(batches):
        task, number, size = TaskContext.get().partitionId(), 0, 0
        found = Sums()
        words: Counter = Counter()
        zip_ = zstandard.ZstdCompressor(level=1)

        def emit():
            chunk = task << 24 | number
            keys, n = found.get()
            part = bucket_of(keys, buckets)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(buckets + 1))
            for b in range(buckets):
                own = order[cut[b]:cut[b + 1]]
                if len(own):
                    yield _rows(chunk, id_type, [(GRAMS, b, None, None, pack_keys(keys[own]), _pack(n[own].astype(np.int64)))])
            dealt: list[list] = [[] for _ in range(buckets)]
            for w in words:
                dealt[zlib.crc32(w) % buckets].append(w)
            for b, own in enumerate(dealt):
                if own:
                    yield _rows(chunk, id_type, [(WORDS, b, None, None, zip_.compress(b"\n".join(own)), _pack(np.array([words[w] for w in own], dtype=np.int64)))])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for part in slices(batch, "text"):
                held = part.column("held").to_pylist()
                made = [stream(t) for t in part.column("text").to_pylist()]
                for is_held in (False, True):
                    some = b"".join(s for s, h in zip(made, held) if h == is_held)
                    for k, _ in windows(some):
                        k, c = counted(k)
                        found.add(k, np.zeros(len(c), np.int64) if is_held else c)
                    own = some.replace(b"\x0b", b"").replace(b"\n", b"").split(b" ")[:-1] if some else []
                    if is_held:
                        words.update(dict.fromkeys(own, 0))
                    else:
                        words.update(own)
                yield _rows(task << 24 | number, id_type, [(STREAMS, -1, part.column("doc_id").to_pylist(), held, zip_.compress(b"".join(made)), None)])
                size += sum(map(len, made))
                if size >= chunk_bytes:
                    yield from emit()
                    number, size, words, found = number + 1, 0, Counter(), Sums()
        if size:
            yield from emit()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(src.mapInArrow(run, CHUNKS.format(id=kind)), "chunks")


def _weigh(table: pa.Table) -> pa.Table:
    """Step 2: a bucket's distinct grams with their predictions at depth 2,
    and one row of sums for each node above."""
    found = Sums()
    for a, b in zip(table["a"], table["b"]):
        found.add(unpack_keys(a.as_py()), _unpack(b.as_py(), np.int64))
    keys, n = found.get()
    p, sums = subtrees(keys, n)
    p = p.astype(np.float32).ravel()  # the wide one goes before it is packed
    m = len(sums)
    return pa.table({
        "bucket": pa.array([table["bucket"][0].as_py()] + [-1] * m, pa.int32()),
        "a": pa.array([pack_keys(keys)] + [None] * m, pa.binary()), "b": pa.array([_pack(p)] + [None] * m, pa.binary()),
        "place": pa.array([None, *sums[:, 0].astype(np.int64).tolist()], pa.int64()),
        **{c: pa.array([None, *sums[:, i].tolist()], pa.float64()) for i, c in enumerate(("n0", "n1", "below"), 1)}})


def _count_words(table: pa.Table) -> pa.Table:
    """A bucket's words: their training counts, for each chunk; and a row of
    totals (chunk -1)."""
    unzip = zstandard.ZstdDecompressor()
    total: Counter = Counter()
    rows = table.select(["chunk", "a", "b"]).to_pylist()
    for r in rows:
        w = unzip.decompress(r["a"]).split(b"\n")
        for x, c in zip(w, _unpack(r["b"], np.int64).tolist()):
            total[x] += c
    out = [_pack(np.array([total[x] for x in unzip.decompress(r["a"]).split(b"\n")], dtype=np.int64)) for r in rows]
    return pa.table({
        "chunk": pa.array([*(r["chunk"] for r in rows), -1], pa.int64()), "kind": pa.array([WORDS] * (len(rows) + 1), pa.int32()),
        "a": pa.array([*(r["a"] for r in rows), None], pa.binary()), "b": pa.array([*out, None], pa.binary()),
        "tokens": pa.array([*([0] * len(rows)), sum(total.values())], pa.int64()),
        "distinct": pa.array([*([0] * len(rows)), sum(c > 0 for c in total.values())], pa.int64())})


def score(docs: DataFrame, held_out: F.Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    and bits_per_byte of every document; held-out ones do not train."""
    spark = docs.sparkSession
    cut = chunks(docs, held_out, chunk_bytes)
    of_grams = cut.where(F.col("kind") == GRAMS).select("chunk", "bucket", "a", "b")
    weighed = written(of_grams.groupBy("bucket").applyInArrow(
        _weigh, "bucket int, a binary, b binary, place long, n0 double, n1 double, below double"), "weighed")
    sums = weighed.where("place is not null").groupBy("place").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).toPandas()
    top = Payload(spark, Top(sums["place"].to_numpy(np.int64), *(sums[c].to_numpy(np.float64) for c in ("n0", "n1", "below"))))

    def finish(own: pa.Table, known: pa.Table) -> pa.Table:
        keys = unpack_keys(known["a"][0].as_py())
        p, two = _unpack(known["b"][0].as_py(), np.float32).reshape(-1, 8), top.get()
        logs = np.empty(len(keys), np.float32)
        for at in range(0, len(keys), STEP_GRAMS):
            s = slice(at, at + STEP_GRAMS)
            logs[s] = two.log10(keys[s], p[s].astype(np.float64))
        del p
        found = [_pack(logs[np.searchsorted(keys, unpack_keys(a.as_py()))]) for a in own["a"]]
        return pa.table({"chunk": own["chunk"], "kind": pa.array([GRAMS] * len(found), pa.int32()),
                         "a": own["a"], "b": pa.array(found, pa.binary())})

    known = weighed.where("place is null").select(F.col("bucket").alias("of"), "a", "b")
    gram_logs = of_grams.groupBy("bucket").cogroup(known.groupBy("of")).applyInArrow(finish, "chunk long, kind int, a binary, b binary")
    words = written(cut.where(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(
        _count_words, "chunk long, kind int, a binary, b binary, tokens long, distinct long"), "word-counts")
    ends = cut.where(F.col("kind") == STREAMS).select(F.explode("held").alias("h")).agg(F.sum((~F.col("h")).cast("long"))).first()[0] or 0
    got = words.agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct = (got[0] or 0) + ends, (got[1] or 0) + (ends > 0)
    facts = gram_logs.union(words.where("chunk >= 0").select("chunk", "kind", "a", "b")).withColumnRenamed("chunk", "of_chunk")
    texts = cut.where(F.col("kind") == STREAMS).select("chunk", "ids", "held", "a")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"

    def judge(own: pa.Table, facts: pa.Table) -> pa.Table:
        unzip = zstandard.ZstdDecompressor()
        id_type = own.schema.field("ids").type.value_type
        keys, logs, count = [np.zeros(0, np.uint64)], [np.zeros(0, np.float32)], {}
        for r in facts.to_pylist():
            if r["kind"] == GRAMS:
                keys.append(unpack_keys(r["a"]))
                logs.append(_unpack(r["b"], np.float32))
            else:
                count.update(zip(unzip.decompress(r["a"]).split(b"\n"), _unpack(r["b"], np.int64).tolist()))
        lookup = Lookup(np.concatenate(keys), np.concatenate(logs))
        out = []
        for r in own.to_pylist():
            streams = unzip.decompress(r["a"])
            out.append((r["ids"], r["held"], *_sums(streams, lookup), *_base(streams, count, tokens, distinct, ends)))
        ids, held, logp, size, n_tokens, n_known, base = ([x for part in c for x in part] for c in zip(*out))
        return pa.table({
            "doc_id": pa.array(ids, id_type), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([tokens] * len(ids), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(logp, pa.float64()),
            "bits_per_byte": pa.array(-np.array(logp) / math.log10(2) / np.array(size), pa.float64())})

    return texts.groupBy("chunk").cogroup(facts.groupBy("of_chunk")).applyInArrow(judge, schema)


def _sums(streams: bytes, lookup: Lookup) -> tuple[list[float], list[int]]:
    """Log10 probability and scored bytes of each stream."""
    done, at, total, seen = [], [], 0.0, 0
    for keys, b in windows(streams):
        c = np.cumsum(lookup.get(keys), dtype=np.float64) + total
        ends = np.flatnonzero(b == END)
        done.append(c[ends])
        at.append(ends + 1 + seen)
        total, seen = float(c[-1]), seen + len(keys)
    return np.diff(np.concatenate(done), prepend=0.0).tolist(), np.diff(np.concatenate(at), prepend=0).tolist()


def _base(streams: bytes, count: dict[bytes, int], tokens: int, distinct: int, ends: int) -> tuple[list[int], list[int], list[float]]:
    """Tokens, known tokens and base score of each stream."""
    whole = tokens + 0.1 * (distinct + 1)
    n_tokens, n_known, base = [], [], []
    for s in streams[:-1].split(b"\n"):
        c = np.fromiter(map(count.__getitem__, s[DEPTH:].split(b" ")[:-1]), np.int64)
        c = np.append(c, ends)
        n_tokens.append(len(c))
        n_known.append(int((c > 0).sum()))
        base.append(float(np.log10((c + 0.1) / whole).sum()))
    return n_tokens, n_known, base


def held_out_rule(doc_id: F.Column) -> F.Column:
    return crc32_of_id(doc_id) % 10 == 0
