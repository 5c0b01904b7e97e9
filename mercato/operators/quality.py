"""Data-quality checks (Q01-Q10).

All rules of one table run in ONE aggregate pass (``count_if`` per rule) and
the single result row is unpivoted into one row per rule.  Uniqueness is a
grouped count (partial aggregation), referential integrity a ``left_anti``
join, SCD integrity a per-key ``lead`` on the dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def not_null(cols: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(c).isNull()) for c in cols]


def positive(cols: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("positive", c, ~F.coalesce(F.col(c) > 0, F.lit(False))) for c in cols]


def accepted_values(col: str, values: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("accepted_values", col, ~F.coalesce(F.col(col).isin(*values), F.lit(False)))]


def timestamp_range(col: str, lo: str, hi: str) -> list[tuple[str, str, Column]]:
    c = F.col(col)
    ok = (c >= F.lit(lo).cast("timestamp_ntz")) & (c < F.date_add(F.lit(hi).cast("date"), 1).cast("timestamp_ntz"))
    return [("timestamp_range", col, ~F.coalesce(ok, F.lit(False)))]


def email_format(col: str) -> list[tuple[str, str, Column]]:
    return [("email_format", col, ~F.coalesce(F.col(col).rlike(EMAIL_PATTERN), F.lit(False)))]


def run_checks(df: DataFrame, table: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One pass over ``df``; one output row per rule."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(bad).alias(f"_f{i}") for i, (_, _, bad) in enumerate(rules)]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(kind).alias("check_type"), F.lit(col).alias("column_name"),
                        F.col(f"_f{i}").alias("records_failed")) for i, (kind, col, _) in enumerate(rules)]
    out = row.select(F.col("_n").alias("records_checked"), F.inline(F.array(*structs)))
    return out.select(F.lit(table).alias("table_name"), "check_type", "column_name", "records_checked",
                      "records_failed",
                      F.when(F.col("records_failed") == 0, "PASS").otherwise("FAIL").alias("check_result"))


def uniqueness(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key (partial aggregation; a hot duplicate
    key is combined map-side)."""
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("c"))
    a = g.agg(F.sum("c").alias("records_checked"), F.sum(F.col("c") - 1).alias("records_failed"))
    return a.select(F.lit(table).alias("table_name"), F.lit("unique").alias("check_type"),
                    F.lit(",".join(cols)).alias("column_name"),
                    F.coalesce("records_checked", F.lit(0)).cast("long").alias("records_checked"),
                    F.coalesce("records_failed", F.lit(0)).cast("long").alias("records_failed"),
                    F.when(F.coalesce("records_failed", F.lit(0)) == 0, "PASS").otherwise("FAIL").alias("check_result"))


def referential(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                table: str, name: str) -> DataFrame:
    """Child rows whose key has no parent row.  Child rows are counted per key
    first (combined map-side, so a hot key is one row), then joined to the
    distinct parent keys."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    c = child.groupBy(F.col(child_key).alias("_ck")).agg(F.count(F.lit(1)).alias("_n"))
    j = c.join(p, c["_ck"] == p["_pk"], "left")
    a = j.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("records_checked"),
              F.coalesce(F.sum(F.when(F.col("_pk").isNull(), F.col("_n"))), F.lit(0)).alias("records_failed"))
    return a.select(F.lit(table).alias("table_name"), F.lit("referential").alias("check_type"),
                    F.lit(name).alias("column_name"), "records_checked", "records_failed",
                    F.when(F.col("records_failed") == 0, "PASS").otherwise("FAIL").alias("check_result"))


def scd_integrity(dim: DataFrame, key: str, table: str) -> DataFrame:
    """Per key: versions must not overlap or leave gaps, exactly one current
    version, and current <=> open expiry.  The window is per key over its
    versions (a handful per key)."""
    w = Window.partitionBy(key).orderBy("effective_date")
    d = dim.select(key, "effective_date", "expiry_date", "is_current",
                   F.lead("effective_date").over(w).alias("_next"))
    per_row = d.select(
        key,
        (F.col("_next").isNotNull() & (F.col("expiry_date").isNull() | (F.col("expiry_date") > F.col("_next")))).alias("overlap"),
        (F.col("_next").isNotNull() & F.col("expiry_date").isNotNull() & (F.col("expiry_date") < F.col("_next"))).alias("gap"),
        (F.col("is_current") != F.col("expiry_date").isNull()).alias("flag_mismatch"),
        F.col("is_current").cast("int").alias("cur"))
    per_key = per_row.groupBy(key).agg(F.max("overlap").alias("overlap"), F.max("gap").alias("gap"),
                                       F.max("flag_mismatch").alias("flag_mismatch"), F.sum("cur").alias("cur"))
    rules = [("scd_no_overlap", "effective_date", F.col("overlap")),
             ("scd_no_gap", "effective_date", F.col("gap")),
             ("scd_current_open", "is_current", F.col("flag_mismatch")),
             ("scd_one_current", "is_current", F.col("cur") != 1)]
    return run_checks(per_key, table, rules)


def audited_write(df: DataFrame, path: str, pipeline_name: str, failed_when: Column | None = None,
                  mode: str = "overwrite", log_path: str | None = None) -> DataFrame:
    """Write the rows of ``df`` that do not fail and return the audit-log row
    (Q10), appended to ``log_path`` if given.  Row counts come from
    ``DataFrame.observe`` - collected by the same job that writes, no second
    pass over the data.  A failed write is logged and raised."""
    import datetime as dt

    from pyspark.sql import Observation

    obs = Observation(f"audit_{pipeline_name}")
    bad = failed_when if failed_when is not None else F.lit(False)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_processed"), F.count_if(bad).alias("rows_failed"))
    good = observed.filter(~F.coalesce(bad, F.lit(False)))
    start = dt.datetime.now()

    def log(status: str, processed: int, failed: int, error: str | None) -> DataFrame:
        row = [(pipeline_name, start, dt.datetime.now(), status, processed, processed - failed, 0, failed, error)]
        out = df.sparkSession.createDataFrame(row, AUDIT_SCHEMA)
        if log_path is not None:
            append_log(out, log_path)
        return out

    try:
        good.write.mode(mode).parquet(path)
    except Exception as e:
        log("failed", 0, 0, str(e))  # the log has the failure, and the caller sees it too
        raise
    m = obs.get
    return log("success", int(m["rows_processed"]), int(m["rows_failed"]), None)


AUDIT_SCHEMA = ("pipeline_name string, start_timestamp timestamp_ntz, end_timestamp timestamp_ntz, status string, "
                "rows_processed long, rows_inserted long, rows_updated long, rows_failed long, error_message string")


def append_log(rows: DataFrame, path: str) -> DataFrame:
    """Append rows to a log table (Q09, Q10) and return the whole log."""
    rows.coalesce(1).write.mode("append").parquet(path)
    return rows.sparkSession.read.parquet(path)
