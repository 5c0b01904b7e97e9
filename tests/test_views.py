"""The reporting views follow their tables."""

import uuid

from conftest import SF001
from mercato.plans.views import register_reporting_views
from mercato.session import scratch_path


def test_registering_computes_nothing_and_reads_are_new(spark):
    folder = scratch_path(spark, "t-views")
    for t in ("orders", "customer", "part", "lineitem", "events"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        register_reporting_views(spark, folder)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    for job in status.getJobIdsForGroup(group):  # one task each, for a table's footer
        stages = [status.getStageInfo(i) for i in status.getJobInfo(job).stageIds]
        assert [s.numTasks for s in stages if s] == [1]
    views = ("customer_rfm", "customer_lifetime_value", "product_performance", "product_bestsellers")
    before = {v: spark.table(v).count() for v in views}
    assert min(before.values()) > 0
    who = spark.sql("SELECT customer_id, frequency FROM customer_rfm ORDER BY customer_id").first()
    spark.sql(f"SELECT * FROM parquet.`{folder}/orders.parquet`").where(f"o_custkey = {who[0]} AND o_orderstatus = 'F'").limit(1).selectExpr(
        "-1L AS o_orderkey", "* EXCEPT (o_orderkey)").write.mode("append").parquet(f"{folder}/orders.parquet")
    # the same view, not registered again
    assert spark.sql(f"SELECT frequency FROM customer_rfm WHERE customer_id = {who[0]}").first()[0] == who[1] + 1
    assert spark.sql(f"SELECT total_orders FROM customer_lifetime_value WHERE customer_id = {who[0]}").first()[0] == who[1] + 1
    assert {v: spark.table(v).count() for v in views} == before
