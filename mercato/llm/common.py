"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import scratch_path

#: Bytes of text that one step inside a task handles at once.
SLICE_BYTES = 4 << 20
#: Rows that one such step handles at once.
SLICE_ROWS = 8192


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back: the
    lineage ends there, and later passes see one physical result whatever
    executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of a plan's input as Spark estimates them (the size of the files
    under a scan), 0 where it has no estimate; no job runs."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 53 else 0


def crc32_of_id(col) -> F.Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive zero-copy slices of a batch with at most SLICE_BYTES in
    ``column`` (one row at least) and at most SLICE_ROWS rows."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64)
    at, done = 0, 0
    while at < n:
        stop = int(np.searchsorted(ends, done + SLICE_BYTES, side="right"))
        stop = min(max(stop, at + 1), at + SLICE_ROWS, n)
        yield batch.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


def append_columns(df: DataFrame, make: Callable[[], Callable[[list], list]],
                   fields: list[T.StructField], text: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` with columns computed from its text column, in one
    Arrow map (no shuffle).

    ``make`` is called once per task and returns the function of a slice: a
    list of texts to a list of one Arrow array per field.  ``keep`` are the
    columns to carry (default: all).  A carried column with the name of a new
    one gives way to it.
    """
    new = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    src = df.select(*[F.col(f"`{c}`") for c in kept], *([] if text in kept else [F.col(f"`{text}`").alias("_text_in")]))
    column = text if text in kept else "_text_in"
    schema = T.StructType([src.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_worker(None, lambda: None)
        fn = make()
        for batch in batches:
            for part in slices(batch, column):
                cols = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, *fn(part.column(column).to_pylist())], names=[*kept, *new])

    return src.mapInArrow(run, schema)


def pack_array(x: np.ndarray) -> bytes:
    """A compressed array of whole numbers; bytes of equal weight lie together."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_array(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def set_aside(docs: DataFrame, names: list[str], fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` in ``fn(docs)``, where ``fn`` makes columns of
    the given names: own columns with those names are kept apart meanwhile."""
    aside = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c.lower() in names}
    out = fn(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def per_worker(key, make: Callable):
    """``make()``, kept by the Python worker for its later tasks of this kind:
    for objects that are slow to build and of bounded size.  A worker keeps one
    such object; tasks of another kind give it up."""
    held = sys.modules.setdefault("_mercato_worker", types.ModuleType("_mercato_worker")).__dict__
    if held.get("key") != key:
        held.update(key=None, value=None)  # the old one goes before the new one is built
        held.update(value=make(), key=key)
    return held.get("value")


class Payload:
    """A broadcast of a value whose size the caller has bounded.  It travels
    as pickled bytes, so its classes need not be importable on executors."""

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return cloudpickle.loads(self.sent.value)


#: Keys sampled for each cut point.
PER_CUT = 20


def cut_points(keys: DataFrame, key: str, buckets: int) -> list:
    """Keys that cut a table into about ``buckets`` equal ranges, fewer if it
    has few distinct keys.  Every distinct key has the same chance to be in
    the sample, by its hash; one key a range comes to the driver."""
    if buckets < 2:
        return []
    keys = keys.where(F.col(key).isNotNull())
    n = keys.count()
    share = min(1.0, buckets * PER_CUT / max(n, 1))
    sample = keys.distinct().where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    rank = F.row_number().over(Window.orderBy(key))  # over the sample: PER_CUT rows a range
    picked = sample.withColumn("_rank", rank).where(F.col("_rank") % PER_CUT == 0).select(key)
    return sorted(r[0] for r in picked.collect())


def bucket_of(key: F.Column, cuts: list, kind: str) -> F.Column:
    """Number of cuts (sorted) at or below a key, by binary search."""
    if not cuts:
        return F.lit(0)
    held = F.array(*[F.lit(c).cast(kind) for c in cuts])
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda acc, s: F.when(
        (acc + s <= len(cuts)) & (F.get(held, acc + s - 1) <= key), acc + s).otherwise(acc))
