"""Staging clean-up (P09 dedup, P10 null keys, P11 date presets)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.expressions import col_

# Dashboard date-range presets (days back from "as of").
PRESETS = {"7d": 7, "30d": 30, "90d": 90, "1y": None}


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``order`` (then by all other
    columns, so ties are deterministic).  A grouped ``max`` of a struct is
    combined map-side, so a key duplicated a billion times is still cheap -
    unlike ``row_number()`` over a window on that key."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    s = F.struct(*[col_(c).alias(c) for c in order + rest])
    return df.groupBy(*keys).agg(F.max(s).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in order + rest])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def preset_range(as_of: str, preset: str) -> tuple[str, str]:
    """(start, end) date strings for a dashboard preset ending at ``as_of``."""
    end = dt.date.fromisoformat(as_of)
    days = PRESETS[preset]
    if days is None:  # a year back; 29 February has the 28th as its day before
        leap_day = (end.month, end.day) == (2, 29)
        start = end.replace(year=end.year - 1, day=28 if leap_day else end.day)
    else:
        start = end - dt.timedelta(days=days)
    return start.isoformat(), end.isoformat()
