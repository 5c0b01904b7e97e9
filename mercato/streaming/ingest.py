"""Structured Streaming ingestion and incremental operators.

Sources are landing folders read with a declared schema; sinks are file
sinks or ``foreachBatch`` writers with checkpoints, so a restarted query
resumes exactly once.  ``availableNow`` drains what has landed and stops
(a cron-style schedule becomes the caller's trigger).

Event time: landed timestamps are TIMESTAMP_NTZ; days and times are read from
that column as they stand, whatever the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.expressions import epoch_micros
from mercato.operators.cleaning import dedup_latest
from mercato.operators.sessions import session_behavior, sessionize
from mercato.schemas import RAW_EVENTS
from mercato.session import materialize
from mercato.sources.sinks import table_exists
from mercato.sources.tables import events_from_raw


def land(df: DataFrame, path: str, slice_col=None, fmt: str = "parquet", files: int | None = None) -> str:
    """Write ``df`` into a landing folder, one file group per slice (e.g.
    per day), as an upstream system would drop files; with ``files``, that
    many files, by a slice column of whole numbers."""
    if files:
        d = df.withColumn("_slice", slice_col.cast("int")).repartitionById(files, "_slice").drop("_slice")
    else:
        d = df.repartition(slice_col) if slice_col is not None else df
    d.write.mode("overwrite").format(fmt).save(path)
    return path


def read_landed_events(spark: SparkSession, landing: str, schema: T.StructType = RAW_EVENTS,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.parquet(landing)
    # the NTZ wall clock read as UTC: windows and watermarks do not depend on
    # the session time zone
    return s.withColumn("event_time", F.timestamp_micros(epoch_micros("ts")))


def _drain(query) -> None:
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc


def run_to_files(stream: DataFrame, out: str, checkpoint: str, mode: str = "append",
                 partition_by: str | None = None) -> DataFrame:
    """Exactly-once Parquet file sink, drained with ``availableNow``."""
    w = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint) \
        .outputMode(mode).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(partition_by)
    _drain(w.start())
    return stream.sparkSession.read.parquet(out)


def ingest_events(spark: SparkSession, landing: str, out: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed raw events -> staging web events with load timestamp, in
    micro-batches of ``max_files_per_trigger`` files (None: one of all)."""
    s = read_landed_events(spark, landing, max_files_per_trigger=max_files_per_trigger)
    staged = events_from_raw(s).withColumn("load_timestamp", F.current_timestamp())
    return run_to_files(staged, out, checkpoint)


# --- complete results, whatever the order of arrival -------------------------
#
# The operators below keep their state in tables, not in windows that a
# watermark closes: a late row is a row of its day like any other, and a day or
# session that is still open is written and replaced later.  Every micro-batch
# reads only the partitions that it touches, and replaying one changes nothing.


def _partition(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def days_filter(column: str, days: list):
    known = [d for d in days if d is not None]
    here = F.col(column).isin(known) if known else F.lit(False)
    return here | F.col(column).isNull() if None in days else here


def days_of(df: DataFrame, column: str) -> list:
    """Distinct days (null among them): at most the days of the calendar."""
    return [r[0] for r in df.select(column).distinct().collect()]


def overwrite_partitions(target: str, partition: str, parts: list, rows: DataFrame) -> None:
    """Replace whole partitions by ``rows`` (materialised), and remove those of
    ``parts`` that are left without a row.  A reader between the two steps can
    still see a removed partition."""
    spark = rows.sparkSession
    (rows.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(target))
    full = set(days_of(rows, partition))
    for p in parts:
        if p not in full:
            _remove(spark, f"{target}/{partition}={_partition(p)}")


def replace_in_partitions(target: str, partition: str, key: str, touched: DataFrame, fresh: DataFrame) -> None:
    """Replace rows of a table that is partitioned by a date column.

    ``touched`` has the old rows' key (null: none) and the partitions of old
    and new rows; ``fresh`` are the new rows.  The other rows of those
    partitions are kept, the partitions written anew, and those left without a
    row removed.  The number of touched partitions comes to the driver, as a
    list of dates."""
    spark = fresh.sparkSession
    touched = materialize(touched.select(key, partition).distinct())
    parts = days_of(touched, partition)
    if not parts:
        return
    rows = fresh
    if table_exists(spark, target):
        old = spark.read.schema(fresh.schema).parquet(target)
        kept = old.filter(days_filter(partition, parts)).join(
            touched.filter(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")
        rows = kept.select(*fresh.columns).unionByName(fresh)
    overwrite_partitions(target, partition, parts, materialize(rows))  # read before its partitions are overwritten


def _run(stream: DataFrame, upsert, checkpoint: str) -> None:
    _drain(stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())


def _merge_events(batch: DataFrame, staged: str, journal: str, epoch_id: int) -> DataFrame:
    """Bring a batch into the staged table, which holds the latest delivery of
    each event (by ``ts``, then the other columns, as ``dedup_latest`` does), by
    day.  The result names what may have changed: (user_id, ts, day) of the
    batch's events and of the deliveries that they replace.

    Ids are matched over the whole table (a narrow scan of id and day), full
    rows read from the days with a match only; new events are appended, replaced
    ones rewritten with their days.  The result is written to ``journal`` before
    anything changes, so a batch that is run again after a failure names the same."""
    spark = batch.sparkSession
    _remove(spark, f"{journal}/epoch={epoch_id - 1}")
    journal = f"{journal}/epoch={epoch_id}"
    b = materialize(dedup_latest(batch.withColumn("day", F.to_date("ts")), ["event_id"], ["ts"]))
    place = ["user_id", "ts", "day"]
    touched, known, old = b.select(*place), None, None
    if table_exists(spark, staged):
        table = spark.read.schema(b.schema).parquet(staged)
        known = materialize(table.select("event_id", "day").join(b.select("event_id"), "event_id"))
        days = days_of(known, "day")
        if days:
            same = b.select("event_id", F.struct(*[c for c in b.columns if c != "event_id"]).alias("_new"))
            old = table.filter(days_filter("day", days)).join(same, "event_id")
            rest = F.struct(*[c for c in b.columns if c != "event_id"])
            old = materialize(old.filter(F.col("_new") > rest).drop("_new"))  # deliveries that the batch replaces
            touched = touched.unionByName(old.select(*place))
    if table_exists(spark, journal):
        touched = spark.read.schema(touched.schema).parquet(journal)
    else:
        touched.write.mode("overwrite").parquet(journal)
        touched = spark.read.schema(touched.schema).parquet(journal)
    new = b if known is None else b.join(known.select("event_id"), "event_id", "left_anti")
    new.repartition("day").write.mode("append").partitionBy("day").parquet(staged)
    if old is not None:
        fresh = b.join(old.select("event_id"), "event_id", "left_semi")
        moved = old.select("event_id", "day").unionByName(fresh.select("event_id", "day"))
        replace_in_partitions(staged, "day", "event_id", moved, fresh)
    return touched


def dedup_events_stream(spark: SparkSession, landing: str, out: str, checkpoint: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """One row an event, its latest delivery, whatever the order of arrival
    and however late one comes, also if it moves the event to another day.
    Nothing is kept in memory between batches."""
    s = read_landed_events(spark, landing, max_files_per_trigger=max_files_per_trigger).drop("event_time")

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        _merge_events(batch, out, f"{checkpoint}-journal", epoch_id)

    _run(s, upsert, checkpoint)
    return spark.read.parquet(out)


def daily_metrics_stream(spark: SparkSession, landing: str, out: str, checkpoint: str,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Per-day event metrics with exact visitor counts (events without a
    time have the null day); the daily funnel's sessions are X04's.  A batch's
    events are staged by day; the days that they touch are counted anew and
    replaced."""
    staged = out.rstrip("/") + "-staged"

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        days = days_of(_merge_events(batch, staged, f"{checkpoint}-journal", epoch_id), "day")
        if not days:
            return
        ev = spark.read.parquet(staged).filter(days_filter("day", days))
        per_user = ev.groupBy("day", "user_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") == "view").alias("pv"),
            F.count_if(F.col("event_type") == "click").alias("atc"),
            F.count_if(F.col("event_type") == "purchase").alias("pur"),
            F.sum(F.col("value").cast("decimal(18,2)")).alias("v"))
        g = per_user.groupBy(F.col("day").alias("metric_date")).agg(
            F.sum("n").alias("events"), F.count("user_id").alias("visitors"), F.sum("pv").alias("product_views"),
            F.sum("atc").alias("add_to_cart"), F.sum("pur").alias("purchases"), F.sum("v").cast("decimal(28,2)").alias("value"))
        overwrite_partitions(out, "metric_date", days, materialize(g))

    _run(read_landed_events(spark, landing, max_files_per_trigger=max_files_per_trigger).drop("event_time"), upsert, checkpoint)
    return spark.read.parquet(out)


def sessions_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, gap_seconds: int = 6 * 3600,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Session rollup, open sessions included.  A batch's events are staged
    by day.  For each user and day of them (and of the deliveries that they
    replace), the stored sessions within the gap are taken back, and the events
    of those stretches are cut into sessions anew: late events may join, split
    off or merge sessions.  Only the days of those stretches are read, so one
    event that is a year late reads its own days, not the year.  A batch that is
    run again after a failure does the same work with the same result."""
    staged = out.rstrip("/") + "-staged"
    gap = F.expr(f"INTERVAL {int(gap_seconds)} SECONDS")

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        touched = _merge_events(batch, staged, f"{checkpoint}-journal", epoch_id).filter("user_id IS NOT NULL AND ts IS NOT NULL")
        reach = touched.groupBy(F.col("user_id").alias("customer_id"), "day").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).drop("day")
        taken = None
        if table_exists(spark, out):
            old = spark.read.parquet(out).select("customer_id", "session_id", "start_day", "event_timestamp_min", "event_timestamp_max")
            taken = old.join(reach, "customer_id").filter(
                (F.col("event_timestamp_max") >= F.col("lo") - gap) & (F.col("event_timestamp_min") <= F.col("hi") + gap))
            taken = materialize(taken.drop("lo", "hi").distinct())
            reach = reach.unionByName(taken.select("customer_id", F.col("event_timestamp_min").alias("lo"), F.col("event_timestamp_max").alias("hi")))
        stretch = materialize(reach.select(F.col("customer_id").alias("user_id"), "lo", "hi", F.explode(
            F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day")))
        days = days_of(stretch, "day")
        if not days:
            return
        ev = spark.read.parquet(staged).filter(days_filter("day", days))
        ev = ev.join(stretch, ["user_id", "day"]).filter(F.col("ts").between(F.col("lo"), F.col("hi"))).drop("lo", "hi", "day").distinct()
        fresh = session_behavior(sessionize(events_from_raw(ev), gap_seconds)).withColumn("start_day", F.to_date("event_timestamp_min"))
        fresh = materialize(fresh)
        moved = fresh.select(F.lit(None).cast("string").alias("session_id"), "start_day")
        if taken is not None:
            moved = moved.unionByName(taken.select("session_id", "start_day"))
        replace_in_partitions(out, "start_day", "session_id", moved, fresh)

    _run(read_landed_events(spark, landing, max_files_per_trigger=max_files_per_trigger).drop("event_time"), upsert, checkpoint)
    return spark.read.parquet(out)


def orders_upsert_stream(spark: SparkSession, landing: str, target: str, checkpoint: str,
                         schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """The table holds the greatest ``load_seq`` of every order, whatever
    the order of arrival.  A batch is de-duplicated and compared with the
    stored rows of its orders (a narrow scan of id, sequence and month); a
    stale row changes nothing, and an order whose date has moved leaves its old
    month."""

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        b = batch.withColumn("order_month", F.trunc(F.col("order_date").cast("date"), "month"))
        b = dedup_latest(b.filter(F.col("order_id").isNotNull()), ["order_id"], ["load_seq"])
        none = F.lit(None)
        if table_exists(spark, target):
            old = spark.read.schema(b.schema).parquet(target).select(
                "order_id", F.col("load_seq").alias("_seq"), F.col("order_month").alias("_month"))
            b = b.join(old, "order_id", "left").filter(F.col("_seq").isNull() | (F.col("load_seq") >= F.col("_seq")))
        else:
            b = b.withColumns({"_seq": none.cast(b.schema["load_seq"].dataType), "_month": none.cast("date")})
        b = materialize(b)
        touched = b.select("order_id", "order_month").unionByName(
            b.filter(F.col("_seq").isNotNull()).select("order_id", F.col("_month").alias("order_month")))
        replace_in_partitions(target, "order_month", "order_id", touched, b.drop("_seq", "_month"))

    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    _run(r.parquet(landing), upsert, checkpoint)
    return spark.read.parquet(target)
