"""Column expressions shared by the operators.  All are built-in Spark
expressions (codegen'd, JVM side); no Python UDF anywhere in the library."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (wall clock, no time
    zone involved, whatever the session zone is)."""
    c = col_(ts)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))




def date_key(ts) -> Column:
    """yyyymmdd integer key of the dim_date row for a timestamp or date."""
    d = col_(ts).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def time_key(ts) -> Column:
    """Second of day, the dim_time key."""
    c = col_(ts)
    return (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")


def month_start(ts) -> Column:
    return F.trunc(col_(ts).cast("date"), "month")


def months_between_starts(later, earlier) -> Column:
    """Whole calendar months between two month-start dates."""
    a, b = col_(later), col_(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")


def ratio(num, den) -> Column:
    """num / den in double, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))




def money_avg(sum_col, count_col) -> Column:
    """Average of an exact decimal sum, as double: sum/count computed once."""
    return ratio(col_(sum_col), col_(count_col))


# The RFM segment ladder (first match wins) as (condition over
# the scores r, f and m, segment), and the segment of all others.
SEGMENT_LADDER = [
    ("r >= 4 AND f >= 4 AND m >= 4", "Champions"),
    ("r >= 3 AND f >= 3 AND m >= 3", "Loyal Customers"),
    ("r >= 4 AND f <= 2", "New Customers"),
    ("r <= 2 AND f >= 3", "At Risk"),
    ("r <= 2 AND f <= 2", "Lost Customers"),
    ("r >= 3 AND f <= 2", "Potential Loyalists"),
]
OTHER_SEGMENT = "Regular Customers"


def segment_sql(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> str:
    """The ladder as SQL text over three score columns."""
    names = {"r": r, "f": f, "m": m}
    whens = " ".join(f"WHEN {' '.join(names.get(w, w) for w in cond.split(' '))} THEN '{segment}'" for cond, segment in SEGMENT_LADDER)
    return f"CASE {whens} ELSE '{OTHER_SEGMENT}' END"


def segment_ladder(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    """RFM segment ladder, first match wins."""
    return F.expr(segment_sql(r, f, m))


def rfm_score_string(r="r_score", f="f_score", m="m_score") -> Column:
    return F.concat(col_(r).cast("string"), col_(f).cast("string"), col_(m).cast("string"))


def activity_status(recency_days) -> Column:
    d = col_(recency_days)
    return F.when(d <= 30, "Active").when(d <= 90, "At Risk").otherwise("Inactive")




def surrogate_key(*cols) -> Column:
    """Deterministic surrogate key (replaces AUTOINCREMENT; no global
    row_number, so no single-task numbering): 128 bits, so a collision is
    unlikely up to some 10^18 keys.  The columns are written as one JSON text,
    so no two different lists of values look alike."""
    return F.md5(F.to_json(F.struct(*[col_(c).alias(f"k{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "false"}))
