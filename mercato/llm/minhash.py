"""Document fingerprints: one-permutation MinHash with optimal densification.

A text's shingles are its runs of ``SHINGLE`` words (lower-cased A-Z, split at
ASCII white space; fewer words: the whole sequence).  Each shingle is hashed
once; the high bits of the hash choose one of ``BINS`` bins, and a bin keeps
its smallest hash.  An empty bin takes the value of the first full bin in its
own fixed pseudo-random order of the bins (optimal densification: the choice
is independent for every empty bin, and the same in every document).  Of each
value, hashed with its bin, the low ``BITS`` bits are stored, so a fingerprint
has BINS x BITS bits.

Likeness of two fingerprints: the share of equal bins, corrected for the
2**-BITS of unlike values whose low bits agree, and kept within 0 and 1.

``with_next`` compares each document with its edited text (its last half
replaced by the first code points of the next document) and with the next
document, in ascending order of doc_id; after the last comes the first.
Documents are dealt by ranges of doc_id, one shuffle of the texts.  Ranges
start at sampled ids, so the first document of each is known beforehand, and
its text also goes to the end of the range before it.  Ranges are streamed, a
slice at a time.

Defined results: a text without words has the empty fingerprint '' , which is
like itself (1) and unlike all others (0).  Null text is empty.  Null doc_ids
come first; rows of equal doc_id follow each other in the order of their text.
A single document is its own next one.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import SLICE_BYTES, SLICE_ROWS, bucket_of, cut_points, slices

SHINGLE = 5
BINS = 512
BITS = 4
RANGE_BYTES = 16 << 20
#: Words whose hash a task keeps.
WORDS = 300_000
_NONE = np.iinfo(np.uint64).max

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Order in which bin i looks for a full bin (row i), from a fixed seed.
_ORDER = np.argsort(np.random.default_rng(20).random((BINS, BINS)), axis=1).astype(np.int16)
#: Bins that took the same value still compare different low bits.
_SALT = np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class Hasher:
    """Fingerprints of many texts at once; keeps the hashes of frequent words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [t.encode().lower().split() for t in texts]
        if len(self.known) > WORDS:
            self.known = {}
        new = [w for w in set().union(*split) if w not in self.known]
        h = xxhash.xxh64_intdigest
        self.known.update((w, h(w)) for w in new)
        at = self.known.__getitem__
        flat = np.fromiter((x for words in split for x in map(at, words)), np.uint64, sum(map(len, split)))
        return flat, np.array([len(w) for w in split], dtype=np.int64)

    def bins(self, texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Smallest hash of every bin [text, bin] (all ones: empty), and which
        texts have words."""
        flat, length = self._words(texts)
        start = np.cumsum(length) - length
        out = np.full((len(texts), BINS), _NONE, dtype=np.uint64)
        # h(i) covers the words i .. i + shingle - 1, or up to the end of a
        # shorter text
        h = np.zeros(len(flat), dtype=np.uint64)
        left = np.repeat(start + length, length) - np.arange(len(flat))
        for k in range(shingle):
            more = np.flatnonzero(left > k)
            h[more] = _mix(h[more] + np.uint64(0x9E3779B97F4A7C15) + flat[more + k])
        doc = np.repeat(np.arange(len(texts)), length)
        whole = (left >= shingle) | ((np.repeat(length, length) < shingle) & (np.arange(len(flat)) == np.repeat(start, length)))
        h, doc = h[whole], doc[whole]
        cell = doc * BINS + (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        np.minimum.at(out.reshape(-1), cell, h)
        return out, length > 0

    def fingerprints(self, texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """[text, bin] low bits, densified (all zero without words), and which
        texts have words."""
        value, has = self.bins(texts, shingle)
        densify(value, has)
        low = _mix(value + _SALT) & np.uint64((1 << BITS) - 1)
        return np.where(has[:, None], low, 0).astype(np.uint8), has


def densify(value: np.ndarray, has: np.ndarray) -> None:
    """Fill the empty bins of the rows that have a full one, in place."""
    empty = value == _NONE
    row, col = np.nonzero(empty & has[:, None])
    full = ~empty
    filled = value.copy()
    turn = 0
    while len(row):
        source = _ORDER[col, turn]
        ok = full[row, source]
        filled[row[ok], col[ok]] = value[row[ok], source[ok]]
        row, col = row[~ok], col[~ok]
        turn += 1
    value[:] = filled


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bias-corrected share of equal bins, row by row."""
    same = (a == b).mean(axis=1)
    chance = 1 / (1 << BITS)
    return np.clip((same - chance) / (1 - chance), 0, 1)


def _alike(a, has_a, b, has_b) -> np.ndarray:
    return np.where(has_a & has_b, likeness(a, b), (has_a == has_b).astype(float))


def edited(text: str, following: str) -> str:
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def to_hex(low: np.ndarray, has: np.ndarray) -> list[str]:
    packed = (low[:, 0::2] << 4 | low[:, 1::2]).astype(np.uint8)
    return [p.tobytes().hex() if h else "" for p, h in zip(packed, has)]


def from_hex(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    has = np.array([bool(f) for f in fingerprints])
    raw = np.array([list(bytes.fromhex(f or "00" * (BINS // 2))) for f in fingerprints], dtype=np.uint8).reshape(-1, BINS // 2)
    return np.stack([raw >> 4, raw & 15], axis=2).reshape(-1, BINS), has


def compare(texts: list[str], following: list[str], hasher: Hasher) -> list[pa.Array]:
    """Columns of the documents ``texts``, each with its next document's text
    (that of the next one in the list, and one more)."""
    new = [edited(t, f) for t, f in zip(texts, following)]
    low, has = hasher.fingerprints([*texts, following[-1]])
    mine, has_mine = hasher.fingerprints(new)
    return [pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
            pa.array(to_hex(low[:-1], has), pa.string()), pa.array(to_hex(mine, has_mine), pa.string()),
            pa.array(_alike(low[:-1], has[:-1], mine, has_mine)), pa.array(_alike(low[:-1], has[:-1], low[1:], has[1:]))]


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    total, low, nulls = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    low = 0 if low is None else low
    first = low - 1 if nulls else low  # nulls come before all ids
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(low - 1))
    # a range a shuffle partition, more if they would be large
    ranges = max(-(-(total or 0) // range_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    starts = sorted({first, *cut_points(docs.select(key.alias("k")), "k", ranges)})
    part = bucket_of(key, starts, "bigint") - 1
    # a range's first document is also the next one of the range before it
    before = F.pmod(F.col("part") - 1, F.lit(len(starts)))
    places = F.when(key == F.get(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("part")),
                    F.array(F.struct(F.col("part"), F.lit(False).alias("after")), F.struct(before.alias("part"), F.lit(True).alias("after"))))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), part.alias("part"), key.alias("key"))
            .withColumn("at", F.explode(F.coalesce(places, F.array(F.struct(F.col("part"), F.lit(False).alias("after"))))))
            .select("at.part", "at.after", "key", "doc_id", "text")
            .repartitionById(len(starts), "part").sortWithinPartitions("part", "after", "key", "text"))

    def run(batches):
        hasher = Hasher()
        ids, texts, size = [], [], 0

        def emit(count, last):
            cols = compare(texts[:count], [*texts[1:], *last][:count], hasher)
            return pa.RecordBatch.from_arrays([pa.array(ids[:count], id_type), *cols], names=names)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for piece in slices(batch, "text"):
                for after, d, t in zip(piece.column("after").to_pylist(), piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    if after:  # ends a range; of rows with the same id, the first is next
                        if texts:
                            yield emit(len(texts), [t])
                        ids, texts, size = [], [], 0
                        continue
                    ids.append(d)
                    texts.append(t)
                    size += len(t)
                    if size >= SLICE_BYTES or len(texts) > SLICE_ROWS:
                        if len(texts) > 1:
                            yield emit(len(texts) - 1, [])
                        ids, texts, size = ids[-1:], texts[-1:], 0

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
