"""Token counts of whole texts without materialising ids.

A sentencepiece BPE model with identity normalisation never merges across the
start of a run of spaces or across a line end, so a text's count is the sum of
its *pre-tokens'* counts: line ends, and stretches of other characters that
start at a run of spaces.  (``check_model`` proves this for the model at hand
from its pieces and settings, and raises otherwise.)

1. One map over the documents cuts them into *chunks* of about ``CHUNK_BYTES``
   of text, and writes for each chunk its distinct pre-tokens, numbered, and
   each document's frequencies as (numbers, counts).
2. Pre-tokens are dealt to buckets by a hash; a bucket encodes each distinct
   one once, and returns the numbers of pieces to the chunks.
3. A chunk's numbers of pieces are one array; a document's count is the sum of
   frequency times pieces.

Words and frequencies are packed a bucket or a slice of documents at a time,
never a row a word: a hot pre-token is one entry a chunk, like any other, and
what is shuffled is the chunks' vocabularies and some hundred bytes a document.

Defined results: null or empty text has 0 bytes and 0 tokens.  Repeated rows
and ids each get their row.  A text of one very long word is one pre-token.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import Payload, input_bytes, pack_array, per_worker, slices, unpack_array, written

PIECES = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK_BYTES = 24 << 20

_PRE = re.compile("\n| *[^ \n]+| +")


def model_path(name: str = PIECES) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def check_model(raw: bytes) -> None:
    """Raise unless counting by pre-tokens is exact for the model."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto.FromString(raw)
    n, t = m.normalizer_spec, m.trainer_spec
    inner = [p.piece for p in m.pieces if "▁" in p.piece.lstrip("▁") or "\n" in p.piece]
    if (n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces
            or t.treat_whitespace_as_suffix or not t.byte_fallback or t.model_type != t.BPE or inner
            or any(p.type == p.USER_DEFINED for p in m.pieces)):
        raise ValueError("this model's pieces may cross pre-tokens")


def pre_tokens(text: str | None) -> list[str]:
    """The pre-tokens of a text, its dummy prefix space included."""
    return _PRE.findall(" " + text.replace("▁", " ")) if text else []


class Counter_:
    """Number of pieces of pre-tokens."""

    def __init__(self, raw: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=raw)
        self.line = len(self.model.encode("\n"))

    def count(self, pre: list[str]) -> np.ndarray:
        # the dummy prefix stands for the first space; a pre-token after a line
        # end has none, so the line end goes in front and is taken off again
        spaced = np.array([p.startswith(" ") for p in pre], dtype=bool)
        got = self.model.encode([p[1:] if s else "\n" + p for p, s in zip(pre, spaced)], num_threads=1)
        n = np.array([len(g) for g in got], dtype=np.int64)
        return np.where(spaced, n + np.array([p == " " for p in pre], dtype=np.int64), n - self.line)


DOCUMENTS, WORDS = 0, 1
#: Buckets at least and at most, and bytes of input that make one more.
BUCKETS, MOST_BUCKETS, BUCKET_BYTES = 64, 8192, 128 << 20


def bucket_count(docs: DataFrame) -> int:
    """Buckets of pre-tokens for an input, by the size of its files."""
    return min(max(BUCKETS, -(-input_bytes(docs) // BUCKET_BYTES)), MOST_BUCKETS)


def chunks(docs: DataFrame, keep: list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Step 1, written: rows of documents (their kept columns, bytes, numbers
    of distinct pre-tokens; all their numbers and frequencies packed) and of
    pre-tokens (a bucket's words and their numbers, packed)."""
    src = docs.select(*keep, F.col("text").alias("_text"))
    buckets = bucket_count(docs)
    kept = "".join(f", `{c}` array<{src.schema[c].dataType.simpleString()}>" for c in keep)

    def run(batches):
        task = TaskContext.get().partitionId()
        chunk, number, size = 0, {}, 0
        zip_ = zstandard.ZstdCompressor(level=1)
        types = None

        def row(kind, bucket, values, a, b):
            cols = [pa.array([v], t) for v, t in zip(values, types)]
            return pa.RecordBatch.from_arrays([pa.array([task << 24 | chunk], pa.int64()), pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()),
                                               *cols, pa.array([a], pa.binary()), pa.array([b], pa.binary())], names=names)

        def vocabulary():
            dealt: list[list] = [[] for _ in range(buckets)]
            for w, i in number.items():
                dealt[zlib.crc32(w.encode()) % buckets].append((w, i))
            for b, own in enumerate(dealt):
                if own:  # a zero byte ends a pre-token: written as the text's own, two bytes
                    words = "\0".join(w.replace("\1", "\1o").replace("\0", "\1z") if "\0" in w or "\1" in w else w for w, _ in own)
                    yield row(WORDS, b, [None] * len(types), zip_.compress(words.encode()),
                              pack_array(np.diff(np.array([i for _, i in own], dtype=np.int32), prepend=np.int32(0))))

        for batch in batches:
            for part in slices(batch, "_text"):
                types = [*(pa.list_(part.column(c).type) for c in keep), pa.list_(pa.int64()), pa.list_(pa.int32())]
                texts = part.column("_text").to_pylist()
                ids, counts, lens = [], [], []
                for t in texts:
                    c = Counter(pre_tokens(t))
                    i = np.fromiter((number.setdefault(w, len(number)) for w in c), np.int32, len(c))
                    order = np.argsort(i)
                    ids.append(np.diff(i[order], prepend=np.int32(0)))
                    counts.append(np.fromiter(c.values(), np.int32, len(c))[order])
                    lens.append(len(c))
                n_bytes = [len(t.encode()) if t else 0 for t in texts]
                yield row(DOCUMENTS, -1, [*(part.column(c).to_pylist() for c in keep), n_bytes, lens],
                          pack_array(np.concatenate(ids)), pack_array(np.concatenate(counts)))
                size += sum(n_bytes)
                if size >= chunk_bytes:
                    yield from vocabulary()
                    chunk, number, size = chunk + 1, {}, 0
        if number:
            yield from vocabulary()

    names = ["chunk", "kind", "bucket", *keep, "n_bytes", "lens", "a", "b"]
    return written(src.mapInArrow(run, f"chunk long, kind int, bucket int{kept}, n_bytes array<long>, lens array<int>, a binary, b binary"), "chunks")


def _words_of(raw: bytes) -> list[str]:
    words = zstandard.ZstdDecompressor().decompress(raw).decode().split("\0")
    return [w.replace("\1z", "\0").replace("\1o", "\1") if "\1" in w else w for w in words]


def count_tokens(docs: DataFrame, keep: list[str] | None = None, path: str | None = None, limit: int = LIMIT,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` (columns ``keep``) with n_bytes, n_tokens and over_limit."""
    with open(path or model_path(), "rb") as f:
        raw = f.read()
    check_model(raw)
    model = Payload(docs.sparkSession, raw)
    made = {"n_bytes", "n_tokens", "over_limit", "chunk", "kind", "bucket", "lens", "a", "b"}
    keep = [c for c in (keep or [c for c in docs.columns if c != "text"]) if c not in made]
    rows = chunks(docs, keep, chunk_bytes)

    def encode(table: pa.Table) -> pa.Table:
        counter = per_worker(("piece counter", hash(raw_key)), lambda: Counter_(model.get()))
        given = table.select(["chunk", "a", "b"]).to_pylist()
        words = [_words_of(r["a"]) for r in given]
        distinct = list(set().union(*words))
        n = dict(zip(distinct, counter.count(distinct).tolist()))
        return pa.table({"chunk": pa.array([r["chunk"] for r in given], pa.int64()), "b": pa.array([r["b"] for r in given], pa.binary()),
                         "n": pa.array([pack_array(np.array([n[w] for w in own], dtype=np.int32)) for own in words], pa.binary())})

    raw_key = raw[:64] + len(raw).to_bytes(8, "little")
    pieces = (rows.where(F.col("kind") == WORDS).select("bucket", "chunk", "a", "b").groupBy("bucket")
              .applyInArrow(encode, "chunk long, b binary, n binary").withColumnRenamed("chunk", "of_chunk"))
    return _summed(rows.where(F.col("kind") == DOCUMENTS).drop("kind", "bucket"), pieces, keep, docs).withColumn(
        "over_limit", F.col("n_tokens") > limit)


def _summed(documents: DataFrame, pieces: DataFrame, keep: list[str], docs: DataFrame) -> DataFrame:
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        given = [(np.cumsum(unpack_array(r["b"], np.int32)), unpack_array(r["n"], np.int32)) for r in right.to_pylist()]
        sizes = np.zeros(1 + max((int(i.max()) for i, _ in given), default=-1), dtype=np.int64)
        for i, n in given:
            sizes[i] = n
        out = []
        for r in left.select(["lens", "a", "b"]).to_pylist():
            lens = np.array(r["lens"], dtype=np.int64)
            start = np.cumsum(lens) - lens
            # numbers were written as steps within each document
            steps = unpack_array(r["a"], np.int32).astype(np.int64)
            total = np.cumsum(steps)
            before = np.where(start > 0, total[np.maximum(start, 1) - 1], 0) if len(total) else np.zeros(len(lens), np.int64)
            number = total - np.repeat(before, lens)
            each = np.r_[0, np.cumsum(sizes[number] * unpack_array(r["b"], np.int32))]
            out.append(each[start + lens] - each[start])
        cols = [pc.list_flatten(left.column(c)) for c in [*keep, "n_bytes"]]
        return pa.table([*cols, pa.array(np.concatenate(out))], names=[*keep, "n_bytes", "n_tokens"])

    return documents.groupBy("chunk").cogroup(pieces.groupBy("of_chunk")).applyInArrow(add, f"{kept}n_bytes long, n_tokens long")
