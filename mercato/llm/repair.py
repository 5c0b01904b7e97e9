"""Token files compressed by Re-Pair grammars, with random access.

Documents go to the file in ascending doc_id order (null first; rows of equal
doc_id in order of their text), each followed by an end id.  The id stream is
cut into *blocks* of about ``BLOCK_TOKENS`` ids (whole documents); a block is one self-contained
grammar.  Re-Pair works in rounds: all adjacent pairs are counted, the pairs
of at least ``MIN_COUNT`` occurrences get a nonterminal each, and occurrences
that do not overlap a more frequent pair's are replaced; later rounds count
only where a pair's count can have changed, until no pair has as many.

File format: a Parquet folder (so that any store Spark reads will do), one row
a block:

* shard, block: order of the blocks; n_docs, n_tokens;
* doc_ids: the documents of the block, always whole; lengths: their ids, end
  id included;
* base: the number of the first nonterminal; left, right: the rules as
  little-endian 32-bit numbers; expansion: the number of ids of each rule;
* width, size, sequence: the final sequence, bit-packed; starts: the stream
  position (in ids) of every ``STRIDE``-th symbol, for random access.

A document's ids are read with ``decode_range``, which expands only the
symbols that cover them.  Shards are ranges of doc_id and of the beginnings of
texts (a sampled range partitioning, about ``SHARD_BYTES`` of text each, but at
most ``MAX_SHARDS``); a task holds one block at a time, however many documents
its shard has.  A document longer than a block is one block.

Defined results: null or empty text is the end id alone; repeated rows are
separate documents; an empty table makes an empty file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm import bpe
from mercato.llm.common import slices
from mercato.session import scratch_path

BLOCK_TOKENS = 1 << 20
SHARD_BYTES = 24 << 20
#: A task holds a block at a time, so beyond this many shards they get larger.
MAX_SHARDS = 20_000
#: Occurrences that make a pair frequent: a shorter file against more time; any
#: value gives files that decode to the same ids.
MIN_COUNT = 8
#: log2 of the size of the table of pairs.
SLOTS = 18
STRIDE = 1024
END_ID = 2

BLOCKS = ("shard long, block int, n_docs long, n_tokens long, doc_ids array<{id}>, lengths array<long>, "
          "base long, left binary, right binary, expansion binary, width int, size long, sequence binary, starts binary")


# --- one block --------------------------------------------------------------

def compress(ids: np.ndarray, min_count: int | None = None) -> dict:
    """Re-Pair grammar of an id sequence: base, left, right, expansion, and
    the final sequence of ids and nonterminals, in which no pair is frequent.

    The first round counts all pairs.  Later ones count where a pair can have
    become frequent or still is: beside the symbols of the round before, and
    at frequent pairs that had to wait; any other pair only loses occurrences."""
    min_count = min_count or MIN_COUNT
    seq = ids.astype(np.int64)
    base = top = int(seq.max(initial=-1)) + 1
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    spot = None  # places of the pairs to count; at first all
    while len(seq) > 1:  # each round replaces the most frequent pair at least
        shift = max(1, int(top).bit_length())
        key = (seq[:-1] << shift | seq[1:]) if spot is None else (seq[spot] << shift | seq[spot + 1])
        order = np.sort(key)
        edge = np.flatnonzero(order[1:] != order[:-1]) + 1
        edge = np.r_[0, edge] if len(order) else edge
        count = np.diff(np.r_[edge, len(order)])
        often = count >= min_count
        pair, count = order[edge[often]], count[often]
        if not len(pair):
            break
        # pairs by falling count (equal ones by a hash: neighbours in a chain
        # must not all wait for the first); of those that share a slot of the
        # table the most frequent is looked up now, the others in a later round
        pair = pair[np.lexsort((pair.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), -count))]
        slot = np.full(1 << SLOTS, len(pair), dtype=np.int32)
        at_slot = _slot(pair)
        slot[at_slot[::-1]] = np.arange(len(pair) - 1, -1, -1)
        hashed = _slot(key)
        found = slot[hashed]
        hit = np.flatnonzero(np.r_[pair, -1][found] == key)
        place, at = hit if spot is None else spot[hit], found[hit]
        rank = np.full(len(seq) + 1, len(pair), dtype=np.int32)  # of the pair at each place, from the second on
        rank[place + 1] = at
        # an occurrence stands if no overlapping one is more frequent; in a run
        # of one pair (a a a a) every other one does.  The rest see what is
        # left in the next round
        before, after = rank[place], rank[place + 2]
        ok = (at < before) & (at <= after)
        run = np.flatnonzero(at == before)
        if len(run):
            p = place[run]
            begins = np.flatnonzero(np.r_[True, np.diff(p) > 1])
            nth = p - np.repeat(p[begins], np.diff(np.r_[begins, len(p)])) + 1
            run = run[nth % 2 == 0]
            ok[run] = at[run] <= after[run]
        taken = np.flatnonzero(ok)
        good = np.bincount(at[taken], minlength=len(pair)) >= max(2, min_count // 2)
        taken = taken[good[at[taken]]]
        if not len(taken):
            break
        stand = place[taken]
        # the next round looks beside the new symbols, and at frequent pairs
        # that wait: those with an occurrence that did not stand or without a slot
        look = np.zeros(len(seq) + 1, dtype=bool)  # by place + 1
        look[place + 1] = True
        lost = slot[at_slot] != np.arange(len(pair))
        if lost.any():
            shared = np.zeros(1 << SLOTS, dtype=bool)
            shared[at_slot[lost]] = True
            near = np.flatnonzero(shared[hashed])
            near = near[np.isin(key[near], pair[lost])]
            look[(near if spot is None else spot[near]) + 1] = True
        look[stand] = look[stand + 1] = True
        seq[stand] = (np.cumsum(good) - 1 + top)[at[taken]]
        keep = np.ones(len(seq), dtype=bool)
        keep[stand + 1] = False
        seq = seq[keep]
        spot = np.flatnonzero(look[1:][keep][:-1])
        left.append(pair[good] >> shift)
        right.append(pair[good] & (1 << shift) - 1)
        top += int(good.sum())
    left, right = np.concatenate(left), np.concatenate(right)
    return {"base": base, "left": left, "right": right, "expansion": _lengths(base, left, right), "seq": seq}


def _slot(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)


def _lengths(base: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    size = np.ones(base + len(left), dtype=np.int64)
    for a, b in _layers(base, left, right):
        size[base + a:base + b] = size[left[a:b]] + size[right[a:b]]
    return size[base:]


def _layers(base: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of rules that refer to earlier stretches only."""
    out, a = [], 0
    deep = np.maximum(left, right)
    while a < len(left):
        later = np.flatnonzero(deep[a:] >= base + a)
        b = a + int(later[0]) if len(later) else len(left)
        out.append((a, b))
        a = b
    return out


def _spread(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, pool: np.ndarray) -> np.ndarray:
    n = size[symbols]
    ends = np.cumsum(n)
    return pool[np.repeat(first[symbols] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]


def expand(base: int, left: np.ndarray, right: np.ndarray, expansion: np.ndarray, seq: np.ndarray) -> np.ndarray:
    """The ids of a sequence of symbols."""
    size = np.r_[np.ones(base, dtype=np.int64), expansion]
    first = np.r_[np.arange(base), np.zeros(len(left), dtype=np.int64)]
    pool = np.arange(base)
    for a, b in _layers(base, left, right):
        both = np.stack([left[a:b], right[a:b]], axis=1).ravel()
        first[base + a:base + b] = len(pool) + np.cumsum(expansion[a:b]) - expansion[a:b]
        pool = np.concatenate([pool, _spread(both, first, size, pool)])
    return _spread(seq, first, size, pool).astype("<u4")


def bit_pack(x: np.ndarray, width: int) -> bytes:
    out = []
    for a in range(0, len(x), 1 << 16):  # a multiple of 8 numbers fills whole bytes
        bits = (x[a:a + (1 << 16), None] >> np.arange(width)) & 1
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def bit_unpack(raw: bytes, width: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.int64)
    b = np.frombuffer(raw, dtype=np.uint8)
    weight = 1 << np.arange(width, dtype=np.int64)
    for a in range(0, n, 1 << 16):
        m = min(1 << 16, n - a)
        bits = np.unpackbits(b[a * width // 8:(a * width + m * width + 7) // 8], bitorder="little", count=m * width)
        out[a:a + m] = bits.reshape(m, width) @ weight
    return out


def encode_block(ids: np.ndarray) -> dict:
    g = compress(ids)
    size = np.r_[np.ones(g["base"], dtype=np.int64), g["expansion"]]
    ends = np.cumsum(size[g["seq"]])
    width = max(1, int(g["base"] + len(g["left"])).bit_length())
    starts = np.r_[0, ends][:-1][::STRIDE] if len(ends) else np.zeros(0, np.int64)
    return {"base": g["base"], **{k: g[k].astype("<u4").tobytes() for k in ("left", "right", "expansion")},
            "width": width, "size": len(g["seq"]), "sequence": bit_pack(g["seq"], width), "starts": starts.astype("<i8").tobytes()}


def _rules(block: dict) -> list[np.ndarray]:
    return [np.frombuffer(block[k], dtype="<u4").astype(np.int64) for k in ("left", "right", "expansion")]


def decode_block(block: dict) -> np.ndarray:
    return expand(block["base"], *_rules(block), bit_unpack(block["sequence"], block["width"], block["size"]))


def decode_range(block: dict, start: int, stop: int) -> np.ndarray:
    """Ids start..stop-1 of a block, from the symbols that cover them."""
    if stop <= start:
        return np.zeros(0, dtype="<u4")
    starts = np.frombuffer(block["starts"], dtype="<i8")
    a = int(np.searchsorted(starts, start, side="right")) - 1
    b = int(np.searchsorted(starts, stop, side="left"))
    lo, hi = a * STRIDE, min(b * STRIDE, block["size"])
    width = block["width"]
    raw = block["sequence"][lo * width // 8:(hi * width + 7) // 8]  # STRIDE is a multiple of 8
    ids = expand(block["base"], *_rules(block), bit_unpack(raw, width, hi - lo))
    return ids[start - int(starts[a]):stop - int(starts[a])]


# --- the file ---------------------------------------------------------------

def write(docs: DataFrame, path: str, end_id: int = END_ID, tokenizer: str | None = None,
          shard_bytes: int = SHARD_BYTES, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the token file of ``docs`` (columns doc_id, text) to ``path``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    definition = bpe.sent(docs.sparkSession, tokenizer)
    shards = max(1, min(-(-total // shard_bytes), MAX_SHARDS))
    ordered = (docs.select("doc_id", "text").repartitionByRange(shards, "doc_id", F.substring("text", 1, 16))
               .sortWithinPartitions("doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = bpe.encoder(definition.get())
        shard = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4")
        block, held, size = 0, [], 0

        def emit():
            ids = np.concatenate([p for _, p in held])
            row = {"shard": shard, "block": block, "n_docs": len(held), "n_tokens": len(ids),
                   "doc_ids": [d for d, _ in held], "lengths": [len(p) for _, p in held], **encode_block(ids)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            schema = _schema(batch.schema.field("doc_id").type)
            for part in slices(batch, "text"):
                for d, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text").to_pylist())):
                    held.append((d, np.concatenate([ids, end])))
                    size += len(ids) + 1
                    if size >= block_tokens:
                        yield emit()
                        block, held, size = block + 1, [], 0
        if held:
            yield emit()

    ordered.mapInArrow(run, BLOCKS.format(id=kind)).write.parquet(path)


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("shard", pa.int64()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                      ("doc_ids", pa.list_(id_type)), ("lengths", pa.list_(pa.int64())), ("base", pa.int64()),
                      ("left", pa.binary()), ("right", pa.binary()), ("expansion", pa.binary()), ("width", pa.int32()),
                      ("size", pa.int64()), ("sequence", pa.binary()), ("starts", pa.binary())])


def with_starts(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``, the ids of all blocks before: shard totals are
    summed over the shards (a row each, MAX_SHARDS at most), blocks within
    their shard."""
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shard_start"))
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = (blocks.select("shard", "block", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)).alias("_block_start"))
          .join(totals, "shard").select("shard", "block", (F.col("_shard_start") + F.col("_block_start")).alias("start")))
    return blocks.join(at, ["shard", "block"])


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a token file, decoded: doc_id, start (ids of all documents
    before), n_tokens, ids_crc32 and, if asked for, ids (little-endian 32-bit)."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for b in batch.to_pylist():
                raw = decode_block(b).tobytes()
                n = np.array(b["lengths"], dtype=np.int64)
                ends = np.cumsum(n)
                each = [raw[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), n.tolist())]
                out = {"doc_id": pa.array(b["doc_ids"], id_type), "start": pa.array(b["start"] + ends - n),
                       "n_tokens": pa.array(n), "ids_crc32": pa.array([zlib.crc32(r) for r in each], pa.int64())}
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(each, pa.binary())} if with_ids else {}))

    return with_starts(blocks).select("doc_ids", "lengths", "base", "left", "right", "expansion", "width", "size", "sequence", "start").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def token_file(docs: DataFrame, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Write the token file of ``docs`` to the shared folder and read it back."""
    path = scratch_path(docs.sparkSession, "token-file")
    write(docs, path, end_id)
    return read_documents(docs.sparkSession, path, with_ids)
