"""Plan-shape tests: no Python in the hot path, no cartesian products,
filters and projections reach the scan, no single-partition window over
customers in the NTILE model."""

import re

import pytest

from conftest import SF001
import __spark_entry__ as E


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return E.queries()


NO_PY = ["sessionize", "session_behavior", "rfm_segments", "product_affinity", "cross_sell", "fact_orders",
         "daily_metrics", "kpis", "dim_customer_scd2", "dq_orders", "masked_customers"]


@pytest.mark.parametrize("name", NO_PY)
def test_no_python_udf(spark, qs, name):
    p = plan(qs[name](spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p


@pytest.mark.parametrize("name", ["affinity_positional", "product_affinity", "affinity_lift", "affinity_top",
                                  "cross_sell", "summary", "kpis"])
def test_no_cartesian_product(spark, qs, name):
    p = plan(qs[name](spark, SF001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_range_filter_pushed_to_scan(spark, qs):
    p = plan(qs["scan_orders"](spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate" in p


def test_customer_filter_reaches_scan(spark, qs):
    p = plan(qs["customer_sessions"](spark, SF001))
    assert "EqualTo(user_id,42)" in p


def test_column_pruning(spark, qs):
    p = plan(qs["rfm_metrics"](spark, SF001))
    assert "o_orderpriority" not in p


def test_ntile_model_has_no_single_partition_window(spark, qs):
    df = qs["rfm_ntile"](spark, SF001)
    p = plan(df)
    assert "RangePartitioning" not in p  # the customers are not sorted
    # what goes to one task are aggregates of scalar subqueries (a row a task):
    # the exchange below each window deals by its partition keys
    lines = [re.sub(r"^[\s:+-]*(\*\(\d+\) )?", "", x) for x in p.split("\n")]
    windows = [i for i, x in enumerate(lines) if x.startswith("Window [")]
    assert windows
    for i in windows:
        below = next(x for x in lines[i:] if x.startswith("Exchange"))
        assert below.startswith("Exchange hashpartitioning(name"), below
    assert df.count() > 0


def test_top_k_is_take_ordered(spark, qs):
    assert "TakeOrderedAndProject" in plan(qs["top_customers"](spark, SF001))


def test_cross_sell_uses_group_limit(spark, qs):
    p = plan(qs["cross_sell"](spark, SF001))
    assert "WindowGroupLimit" in p


def test_incremental_run_pushes_its_bound_into_the_scan(spark):
    import datetime as dt

    from mercato.plans.catalog_io import funnel_days

    p = plan(funnel_days(spark, SF001, since=dt.date(2024, 1, 20)))
    assert "GreaterThanOrEqual(ts,2024-01-19T18:00" in p
