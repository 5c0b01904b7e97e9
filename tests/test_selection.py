"""Exact multi-selection against plain windows and numpy; no job before the
result is asked for."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, rows
from mercato.operators import rfm, selection
from mercato.plans import params as P
from mercato.sources import tables as T


def jobs_of(spark, build):
    """Jobs that run while ``build`` makes a plan, and the plan."""
    import uuid

    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = build()
        return list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), df
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def table(kind, seed):
    rnd = random.Random(seed)
    value = {"ties": lambda i: rnd.choice([1, 1, 1, 2, 7]), "one": lambda i: 5, "spread": lambda i: rnd.randrange(10**6),
             "nulls": lambda i: rnd.choice([None, None, 3, rnd.randrange(50)]), "rising": lambda i: i}[kind]
    return [(i, value(i)) for i in rnd.sample(range(10**6), 777)]


@pytest.mark.parametrize("kind", ["ties", "one", "spread", "nulls", "rising"])
@pytest.mark.parametrize("n", [2, 5, 100])
def test_ntile_equals_the_window(spark, kind, n):
    df = spark.createDataFrame(table(kind, n), "id long, v long").repartition(3)
    got = selection.ntile_scores(df, n, {"t": "v", "u": "-v"}, "id")
    up, down = Window.orderBy("v", "id"), Window.orderBy(F.expr("-v"), "id")
    assert rows(got, "id", "t", "u") == rows(df.select("id", F.ntile(n).over(up).alias("t"), F.ntile(n).over(down).alias("u")))


@pytest.mark.parametrize("size", [0, 1, 2, 4, 5, 6, 11])
def test_ntile_of_few_rows(spark, size):
    df = spark.createDataFrame([(i, i // 2) for i in range(size)], "id long, v long")
    got = selection.ntile_scores(df, 5, {"t": "v"}, "id")
    assert rows(got, "id", "t") == rows(df.select("id", F.ntile(5).over(Window.orderBy("v", "id")).alias("t")))


@pytest.mark.parametrize("kind", ["ties", "one", "spread", "nulls", "rising"])
def test_quantiles_equal_numpy(spark, kind):
    data = table(kind, 3)
    probs = [0, 0.1, 1 / 3, 0.5, 0.8, 1.0]
    df = spark.createDataFrame(data, "id long, v long")
    got = spark.sql(f"WITH {selection.quantile_edges_sql('{src}', dict(v=1), probs)} SELECT e['v'] FROM edges", src=df).first()[0]
    assert np.allclose(got, np.quantile([v for _, v in data if v is not None], probs), rtol=0, atol=1e-9)


def test_scores_run_no_job_while_the_plan_is_built(spark):
    orders, customers = T.orders(spark, SF001), T.customers(spark, SF001)
    for build in (lambda: rfm.rfm_segments(orders, P.AS_OF), lambda: rfm.rfm_ntile(customers, orders, P.AS_OF)):
        jobs, df = jobs_of(spark, build)
        assert jobs == []
        assert df.count() > 0


def test_only_current_customers_are_scored(spark):
    orders, customers = T.orders(spark, SF001), T.customers(spark, SF001)
    versions = customers.withColumn("is_current", F.lit(False)).unionByName(
        customers.where("customer_id % 3 <> 0").withColumn("is_current", F.lit(True)))
    got = rfm.rfm_ntile(versions, orders, P.AS_OF)
    assert rows(got) == rows(rfm.rfm_ntile(customers.where("customer_id % 3 <> 0"), orders, P.AS_OF))


def test_ntile_with_a_text_as_tie_break(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(f"c{i}", rnd.randrange(3)) for i in range(200)], "id string, v long")
    got = selection.ntile_scores(df, 5, {"t": "v"}, "id")
    assert rows(got, "id", "t") == rows(df.select("id", F.ntile(5).over(Window.orderBy("v", "id")).alias("t")))
