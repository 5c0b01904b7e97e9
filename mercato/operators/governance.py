"""Column masking (Q11): PII columns are masked with built-in expressions;
configured columns that do not exist are reported, not failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mask_email(col: str):
    """Keep the domain, hide the local part: ``a.b@x.com`` -> ``***@x.com``."""
    return F.regexp_replace(F.col(col), r"^[^@]*", "***")


def mask_phone(col: str):
    """Keep the last 4 digits."""
    return F.regexp_replace(F.col(col), r"\d(?=(?:\D*\d){4})", "*")


def mask_columns(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Mask the listed columns that exist; return (masked frame, missing)."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    out = df
    for c in columns:
        if c not in present:
            continue
        if "email" in c:
            out = out.withColumn(c, mask_email(c))
        elif "phone" in c:
            out = out.withColumn(c, mask_phone(c))
        else:
            out = out.withColumn(c, F.sha2(F.col(c).cast("string"), 256))
    return out, missing
