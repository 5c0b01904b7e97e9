"""The full pipeline as a dict of DataFrames.  RFM quantiles, the pair
counts' hot baskets and the cohort offsets are looked up by small jobs while
the plans are built; the outputs themselves run when they are written.

The session rollup feeds three consumers (behaviour, funnel, KPIs), so it is
persisted once and released by the caller (``release``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from mercato.operators import affinity, cohort, funnel, metrics, rfm, sessions
from mercato.plans import params as P
from mercato.sources import tables as T


def run_full_pipeline(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None,
                      as_of: str = P.AS_OF) -> dict:
    events = T.web_events(spark, sf_dir, start, end, gap_seconds=P.SESSION_GAP_SECONDS)
    orders = T.orders(spark, sf_dir, start, end)
    lines = T.order_lines(spark, sf_dir)
    if start is not None or end is not None:  # items of the extracted orders only
        lines = lines.join(orders.select("order_id"), "order_id", "left_semi")
    behavior = sessions.session_behavior(events).persist(StorageLevel.MEMORY_AND_DISK)
    return {
        "customer_behavior": behavior,
        "rfm_scores": rfm.rfm_segments(orders, as_of),
        "conversion_funnel": funnel.conversion_funnel_from_behavior(behavior),
        "cohort_retention": cohort.cohort_matrix(orders),
        "product_affinity": affinity.product_affinity(lines, orders),
        "summary": metrics.summary(T.raw_events(spark, sf_dir, start, end), orders),
        "behavior_summary": sessions.behavior_summary(behavior),
    }


def execute(results: dict, write, parallel: int = 4) -> None:
    """Run ``write(name, df)`` for every output.

    The persisted session rollup goes first, so its cache is filled once
    before its three consumers read it.  The other outputs are independent
    jobs; they are submitted from ``parallel`` driver threads so that their
    stages share the executors instead of waiting for each other (Spark
    schedules concurrent jobs of one session).  ``parallel=1`` runs them in
    order."""
    from concurrent.futures import ThreadPoolExecutor

    write("customer_behavior", results["customer_behavior"])
    rest = [(k, df) for k, df in results.items() if k != "customer_behavior"]
    if parallel <= 1:
        for k, df in rest:
            write(k, df)
        return
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for f in [pool.submit(write, k, df) for k, df in rest]:
            f.result()


def release(results: dict) -> None:
    results["customer_behavior"].unpersist()
