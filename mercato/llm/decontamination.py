"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are the windows of the benchmark items: every run of 13
consecutive words (an item of fewer words, but not none, is one window).
Documents are searched whole.  Words are numbered by the vocabulary of the
benchmark block, so a symbol of the search is a word; windows of one length
form a pattern set with its own tables:

* the *shift* table maps a block of up to three words to how far the search
  may move on without passing an occurrence;
* where the shift is 0, the *suffix* table gives the windows that end in that
  block;
* those are compared word by word with the text.

The search runs in one map over the documents, with no shuffle.  Documents
are cut into overlapping lanes that move on together, so a skip is one
vectorised step and a very long document is no long loop.

The benchmark is the stated query set.  It is taken in blocks of at most
``BLOCK_BYTES`` of text; each block is compiled once and broadcast, so no
broadcast grows with the data, and a task holds one block at a time.

Defined results: null or empty text has no words and is not contaminated.
Benchmark rows with null text or null item_id have no windows.  Repeated item
ids count as one item.  Repeated documents each get their row.  An empty
benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import Payload, append_columns

WINDOW = 13
BLOCK_WORDS = 3
BLOCK_BYTES = 8 << 20
LANE = 4096
COMPARE_ROWS = 1 << 17

#: Bytes that are no part of a word become spaces, A-Z become a-z.
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
              else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_hit", T.LongType(), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
    T.StructField("contaminated", T.BooleanType(), False),
]


def words(text: str | None) -> list[bytes]:
    """Words of a text: runs of digits, a-z and non-ASCII characters."""
    return text.encode().translate(_FOLD).split() if text else []


class _Patterns:
    """Tables of the windows of one length."""

    def __init__(self, rows: np.ndarray, owners: list[np.ndarray]):
        order = np.lexsort(rows.T[::-1])
        self.rows = rows[order]
        self.owners = [owners[i] for i in order]
        n, m = rows.shape
        self.m, self.b = m, min(BLOCK_WORDS, m)
        self.bits = max(12, min(22, int(n * m).bit_length() + 3))
        far = m - self.b + 1
        self.shift = np.full(1 << self.bits, far, dtype=np.uint8)
        for end in range(self.b - 1, m):
            np.minimum.at(self.shift, self.block(self.rows, np.full(n, end)), m - 1 - end)
        # suffix table: windows ordered by the hash of their last block
        h = self.block(self.rows, np.full(n, m - 1))
        by = np.argsort(h, kind="stable")
        self.rows, self.owners = self.rows[by], [self.owners[i] for i in by]
        self.suffix, first = np.unique(h[by], return_index=True)
        self.first = np.append(first, n)

    def _mix(self, parts) -> np.ndarray:
        h = np.zeros(len(parts[0]), dtype=np.uint64)
        for p in parts:
            h = (h ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def block(self, rows: np.ndarray, end: np.ndarray) -> np.ndarray:
        at = np.arange(len(rows))
        return self._mix([rows[at, end - k] for k in range(self.b - 1, -1, -1)])

    def ends(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._mix([ids[at - k] for k in range(self.b - 1, -1, -1)])

    def find(self, ids: np.ndarray, pos: np.ndarray, stop: np.ndarray):
        """(end position, window) of every occurrence; a lane looks at end
        positions pos..stop-1 of a text that holds all of its window."""
        found_at, found = [], []
        while True:
            live = pos < stop
            if not live.all():
                pos, stop = pos[live], stop[live]
            if not len(pos):
                break
            h = self.ends(ids, pos)
            s = self.shift[h]
            zero = np.flatnonzero(s == 0)
            if len(zero):
                for a in range(0, len(zero), COMPARE_ROWS):
                    z = zero[a:a + COMPARE_ROWS]
                    at, w = self._confirm(ids, pos[z], h[z])
                    found_at.append(at)
                    found.append(w)
            pos = pos + np.maximum(s, 1)
        empty = np.zeros(0, dtype=np.int64)
        return np.concatenate([empty, *found_at]), np.concatenate([empty, *found])

    def _confirm(self, ids, at, h):
        k = np.searchsorted(self.suffix, h)
        k[k == len(self.suffix)] = 0
        at, k = at[ok := self.suffix[k] == h], k[ok]
        out_at, out = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        size = self.first[k + 1] - self.first[k]
        for j in range(int(size.max(initial=0))):  # the j-th window of each bucket
            has = size > j
            a, w = at[has], self.first[k[has]] + j
            for back in range(self.m):  # word by word, dropping mismatches at once
                same = ids[a - back] == self.rows[w, self.m - 1 - back]
                a, w = a[same], w[same]
                if not len(a):
                    break
            out_at.append(a)
            out.append(w)
        return np.concatenate(out_at), np.concatenate(out)


def compile_block(items: list[tuple[str, str]]) -> tuple[dict, list[_Patterns]]:
    """Vocabulary and pattern tables of (item id, text) pairs."""
    vocab: dict[bytes, int] = {}
    by_len: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        w = [vocab.setdefault(x, len(vocab) + 1) for x in words(text)]
        n = min(WINDOW, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            by_len.setdefault(n, {}).setdefault(tuple(w[i:i + n]), set()).add(item)
    return vocab, [_Patterns(np.array(list(g), dtype=np.int32), [np.array(sorted(s)) for s in g.values()])
                   for _, g in sorted(by_len.items())]


def search(docs: list[list[bytes]], block: tuple[dict, list[_Patterns]], hit: np.ndarray,
           starts: np.ndarray, items: list[set]) -> None:
    """Mark hit words in ``hit`` (all documents end to end) and add the ids
    of occurring items to each document's set."""
    vocab, sets = block
    ids = np.zeros(len(hit), dtype=np.int32)
    for d, w in enumerate(docs):
        if w:
            ids[starts[d]:starts[d + 1]] = np.fromiter(map(vocab.get, w, repeat(0)), np.int32, len(w))
    length = np.diff(starts)
    edge = np.zeros(len(hit) + 1, dtype=np.int32)
    for p in sets:
        d = np.flatnonzero(length >= p.m)
        lanes = -(-(length[d] - p.m + 1) // LANE)
        first = np.repeat(starts[d] + p.m - 1, lanes)
        k = np.arange(len(first)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = first + k * LANE
        at, w = p.find(ids, pos, np.minimum(pos + LANE, np.repeat(starts[d + 1], lanes)))
        if len(at):
            np.add.at(edge, at - p.m + 1, 1)
            np.add.at(edge, at + 1, -1)
            doc = np.searchsorted(starts, at, side="right") - 1
            for a, b in np.unique(np.stack([doc, w], axis=1), axis=0):
                items[a].update(p.owners[b].tolist())
    hit |= np.cumsum(edge[:-1]) > 0


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcasts of the compiled benchmark, one per ``block_bytes`` of text."""
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
            .where("item is not null and text is not null").toLocalIterator())
    out, part, size = [], [], 0
    for r in rows:
        part.append((r["item"], r["text"]))
        size += len(r["text"])
        if size >= block_bytes:
            out.append(Payload(benchmark.sparkSession, compile_block(part)))
            part, size = [], 0
    if part:
        out.append(Payload(benchmark.sparkSession, compile_block(part)))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None,
                  min_share: float = 0.05, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurrence of a window),
    items (sorted ids of items with an occurring window) and contaminated
    (n_hit > 0 and n_hit >= min_share * n_words)."""
    blocks = blocks_of(benchmark, block_bytes)
    per = round(1 / min_share)

    def make():
        held = [blocks[0].get()] if len(blocks) == 1 else None

        def fn(given):
            texts = [words(t) for t in given]
            starts = np.zeros(len(texts) + 1, dtype=np.int64)
            np.cumsum([len(w) for w in texts], out=starts[1:])
            hit = np.zeros(int(starts[-1]), dtype=bool)
            items: list[set] = [set() for _ in texts]
            for block in held or (b.get() for b in blocks):  # one at a time
                search(texts, block, hit, starts, items)
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[starts[1:]] - total[starts[:-1]]
            n_words = np.diff(starts)
            return [pa.array(n_words), pa.array(n_hit), pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                    pa.array((n_hit > 0) & (per * n_hit >= n_words))]
        return fn

    return append_columns(docs, make, FIELDS, keep=keep)


def items_digest(col) -> F.Column:
    return F.sha2(F.concat_ws(",", col), 256)


def brute_force(texts: list[str | None], items: list[tuple[str, str]]) -> list[tuple[int, int, list[str]]]:
    """(n_words, n_hit, items) by plain comparison, for tests."""
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            p = words(text)
            n = min(WINDOW, len(p))
            for i in range(len(p) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == p[i:i + n]:
                        hit.update(range(j, j + n))
                        found.add(item)
        out.append((len(w), len(hit), sorted(found)))
    return out


def item_set_sha256(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
