"""Session construction and lineage helpers.

Library code never creates its own session: every operator takes DataFrames
and uses ``df.sparkSession``.  ``get_spark`` exists for tests, the bench and
local runs only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins with measured sizes
# (runtime broadcast only below the threshold, skew-join splitting of hot
# partitions, partition coalescing); the session time zone is pinned so that
# TIMESTAMP_NTZ -> TIMESTAMP casts are UTC everywhere.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": os.environ.get("MERCATO_PARALLELISM_FIRST", "false"),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB",  # local runs; see cluster_conf
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call sites of every Column call cost three more round trips to the JVM each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # a checkpoint's files go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "mercato", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, pass the session you already have."""
    cpus = os.environ.get("BENCH_CPUS") or "8"
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("MERCATO_DRIVER_MEMORY") or _local_heap()
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _local_heap() -> str:
    """Local-mode heap: 60 % of the machine's memory, at most 16 GB."""
    try:
        with open("/proc/meminfo") as f:
            kb = int(next(line for line in f if line.startswith("MemTotal")).split()[1])
        return f"{max(1, min(16, int(kb * 0.6 / 1024 / 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a cluster run: input splits and shuffle
    partitions of about ``target_partition_bytes`` (so one task's data fits
    in executor memory with room to spill), at least 3 waves of tasks; AQE
    then coalesces small partitions and splits skewed ones at run time."""
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset on a
    ``local`` master (tests) fall back to a fresh scratch folder.  On a
    cluster a machine-local folder would not survive a lost executor, so an
    unset setting is an error there."""
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - Spark Connect: the server owns the setting
        if configured := spark.conf.get("spark.checkpoint.dir", None):
            return configured
        raise RuntimeError("spark.checkpoint.dir is not known to this client: set it in the session") from e
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder shared by all "
                               "executors (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="mercato-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Scratch tables of this process, by checkpoint folder.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, under the shared
    checkpoint folder (never a machine-local temp dir on a cluster)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/mercato-{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def drop_scratch(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Delete the scratch tables that this process has written, but for those
    whose path is in ``keep``; how many there were.  Results that still read them
    must have been written elsewhere by then."""
    paths = [p for p in _SCRATCH if p not in keep]
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _SCRATCH.remove(p)
    return len(paths)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint.  Used where two passes over the
    same data must see one physical layout (global positions)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
