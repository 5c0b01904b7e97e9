"""URL allow and block rules by a sort-merge range join, in native DataFrame
functions only.

A rule (host, path) fits its host and all subdomains if the url's path starts
with the rule's; the longest fitting rule (host and path together) wins, else
``default``.  Two rules of one host and path: block wins.

Canonical keys turn both conditions into intervals.  A key is the host with
its labels reversed and its path, as bytes: ``org.example/`` + path.  A rule
is the interval [key, key + 0xFF) of all keys that start with its own, and
intervals of rules are nested or disjoint.  A url has one key for each host
suffix that may be a rule's (example.org has org and example.org), so
subdomains need no intervals of their own.

The sweep is one sort over the url keys and the ends of the intervals, cut
into ranges of keys ("buckets") at sampled keys; an interval that goes over
several buckets opens anew in each.  Within a bucket the running sum of
openings and closings is the depth of the *stack* of active rules, and the
rule on top is the last one opened at that depth: two window functions, no
range condition and no cross join.

Distinct keys are swept, each once, so neither a hot url nor a key that many
hosts share (the home pages under one top-level domain) gathers rows in a
window; a hot host has many paths and is cut by the sampled keys.  The rule of
each key goes back to its urls by an equi-join, whose hot keys AQE splits.
Sampled keys are the only thing that goes to the driver: one a bucket.

Defined results: null url, or one without ``://``, has empty host and path,
fits no rule and gets the default.  Rows with a null page_id and repeated rows
are judged like others.  Rules with a null host are left out; a null path is
the empty path, which every url of the host starts with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import bucket_of, cut_points, written

DEFAULT = "allow"
#: Url keys that one bucket holds at least on average.
PER_BUCKET = 2_000


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    """Labels of a host, the last first; U+0001 and U+0002 are written as
    others, as U+0001 ends labels in a key."""
    safe = F.replace(F.replace(host, F.lit("\x02"), F.lit("\x02b")), F.lit("\x01"), F.lit("\x02a"))
    return F.reverse(F.split(safe, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "\x01"), F.lit("\x01\x01"), path).cast("binary")


def suffixes(host: Column) -> Column:
    """Reversed labels of every suffix of a host, the host itself included."""
    return F.transform(F.array(_labels(host)), lambda back: F.transform(
        F.sequence(F.lit(1), F.size(back)), lambda n: F.slice(back, 1, n)))[0]


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rules as a table."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _intervals(rules: DataFrame) -> DataFrame:
    host = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.coalesce("path", F.lit(""))
    one = (rules.where("host is not null").select("verdict", host.alias("host"), path.alias("path"))
           .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))  # block sorts after allow
    low = _key(_labels(F.col("host")), F.col("path"))
    return one.select(low.alias("low"), F.concat(low, F.lit(b"\xff")).alias("high"),
                      F.concat("host", "path").alias("rule"), "verdict")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, url: str = "url",
          per_bucket: int = PER_BUCKET) -> DataFrame:
    """``pages`` with host, path, rule (host and path of the winning rule, else
    null) and verdict."""
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    src = pages.select(*[F.col(f"`{c}`") for c in keep], host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    urls = src.select("host", "path").where("host <> ''").distinct()
    keyed = urls.select("host", "path", F.explode(suffixes(F.col("host"))).alias("labels")).select(
        "host", "path", _key(F.col("labels"), F.col("path")).alias("key"))
    keyed = written(keyed, "url-keys")
    keys = keyed.select("key").distinct()
    # at most one bucket for each shuffle partition
    buckets = min(-(-keyed.count() // per_bucket), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = [bytes(c) for c in cut_points(keys, "key", buckets)]
    intervals = _intervals(rules)
    low, high = bucket_of(F.col("low"), cuts, "binary"), bucket_of(F.col("high"), cuts, "binary")
    each = intervals.withColumn("bucket", F.explode(F.sequence(low, high)))
    # an interval that began in an earlier bucket opens before all keys, the
    # outer one (shorter key) first; closings come before keys, as high is open
    opens = each.select("bucket", F.when(F.col("bucket") == low, F.col("low")).otherwise(F.lit(b"")).alias("key"),
                        F.length("low").alias("turn"), F.lit(1).alias("step"), "rule", "verdict")
    blank = F.lit(None).cast("string")
    closes = each.where(F.col("bucket") == high).select(
        "bucket", F.col("high").alias("key"), F.lit(-1).alias("turn"), F.lit(-1).alias("step"), blank, blank)
    points = keys.select(bucket_of(F.col("key"), cuts, "binary").alias("bucket"), "key", F.lit(1 << 30).alias("turn"), F.lit(0).alias("step"),
                         blank, blank)
    events = opens.union(closes).union(points)
    sweep = Window.partitionBy("bucket").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    deep = events.withColumn("depth", F.sum("step").over(sweep))
    stack = Window.partitionBy("bucket", "depth").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("step") == 1, F.struct("rule", "verdict")), ignorenulls=True).over(stack)
    hits = deep.withColumn("top", F.when(F.col("depth") > 0, top)).where("step = 0 and top is not null").select("key", "top.rule", "top.verdict")
    best = F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule"))
    hits = (keyed.join(hits, "key").groupBy("host", "path").agg(best.alias("w"))
            .select("host", "path", F.col("w.rule").alias("rule"), F.col("w.verdict").alias("verdict")))
    return src.join(hits, ["host", "path"], "left").select(*keep, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
