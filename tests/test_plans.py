"""Shape of the physical plans: what would hurt on large tables must not appear."""

import re
from collections import ChainMap
from contextlib import contextmanager

import pytest
from fixtures import models
from pyspark.sql import functions as F

import __spark_entry__ as entrypoint
from tidemart.plans.incremental import order_rows
from tidemart.plans.models import ANALYSES, INTERMEDIATE, MARTS, REPORTS, STAGING, Models
from tidemart.sources.driver_tables import DRIVER_SETTINGS, CommerceFeeds
from tidemart.sources.raw import write_bucketed_feeds, write_monthly_feeds
from tidemart.sources.schemas import RAW_TABLE_GROUP

TABLES = [*STAGING, *INTERMEDIATE, *MARTS, *ANALYSES]


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def large(spark, sf_dir):
    """Models planned as for tables too large to broadcast."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield entrypoint._models(spark, sf_dir)


@pytest.mark.parametrize("name", [*TABLES, *REPORTS])
def test_no_step_that_does_not_scale(name, large):
    plan = plan_of(large[name])
    assert not re.search("Cartesian|NestedLoop|PythonUDF|ArrowEvalPython|MapInPandas", plan)
    # A result without a grouping key ends in one partition, but of partial sums only.
    for line_after in re.findall(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "partial_" in line_after
    if name in TABLES:
        assert "SinglePartition" not in plan


def test_only_needed_columns_and_filters_reach_the_scan(large):
    plan = large["fct_blended_roas"]._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    read = set(re.findall(r"ReadSchema: struct<(l_\S+?)>", plan))
    assert read and all("l_tax" not in columns for columns in read)
    # Customer attributes are not part of the result, so customers are not read.
    assert "customer.parquet" not in plan


def test_marts_without_customer_attributes_skip_the_customer_join(large):
    for name in ("customer_ltv", "fct_attribution_last_touch", "rpt_order_kpis"):
        assert "customer.parquet" not in plan_of(large[name])
    assert "customer.parquet" in plan_of(large["fct_orders"])


def hot_feeds(spark):
    """A third of the orders are guests, a third one customer's; most lines are one product."""
    feeds = CommerceFeeds(spark, "/root/testdata/sf0.01")
    third = F.col("order_id") % 3
    orders = feeds["orders"].withColumn(
        "customer_id",
        F.when(third == 0, None).when(third == 1, F.lit(7).cast("bigint")).otherwise(F.col("customer_id")),
    )
    lines = feeds["order_lines"].withColumn(
        "product_id", F.when(F.col("quantity") < 25, F.lit(5).cast("bigint")).otherwise(F.col("product_id"))
    )
    changed = {"orders": orders.repartition(16), "order_lines": lines.repartition(16)}
    return Models(spark, ChainMap(changed, feeds), DRIVER_SETTINGS)


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "8",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "10KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "8KB",
    # Else such small map outputs are merged to one, which cannot be split.
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "8KB",
}


@pytest.mark.parametrize(
    "name, join",
    [
        ("fct_orders", "customer_id"),
        ("fct_orders", "product_id"),
        ("fct_order_items", "product_id"),
        ("fct_attribution_first_touch", "product_id"),
        ("fct_attribution_first_touch", "customer_id"),
    ],
)
def test_hot_keys_are_split_at_run_time(spark, name, join):
    with settings(spark, **SKEW):
        plan = final_plan_of(hot_feeds(spark)[name])
    assert re.search(rf"SortMergeJoin\(skew=true\) \[{join}#", plan)


def test_sessions_are_aggregated_once(spark, sf_dir):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = final_plan_of(entrypoint._models(spark, sf_dir)["int_sessions_attributed"])
    assert "ReusedExchange" in plan


def test_orders_are_reduced_before_they_meet_sessions(large):
    plan = plan_of(large["int_sessions_attributed"])
    joined = plan[plan.index("SortMergeJoin") :]
    assert joined.count("partial_min_by(struct(order_id") >= 1


def test_first_touch_reads_orders_for_economics_and_one_aggregate(spark, sf_dir):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(entrypoint._models(spark, sf_dir)["fct_attribution_first_touch"])
    assert len(re.findall(r"FileScan parquet \[o_", plan)) == 2


def test_loads_read_touched_months_only(spark, sf_dir, tmp_path):
    feeds = CommerceFeeds(spark, sf_dir)
    write_monthly_feeds(feeds, str(tmp_path))
    names = [t for t in feeds if t not in ("order_lines", "refunds")]
    stored = {t: spark.read.parquet(f"{tmp_path}/{RAW_TABLE_GROUP[t]}/{t}") for t in ("order_lines", "refunds")}
    m = Models(spark, ChainMap(stored, {t: feeds[t] for t in names}), DRIVER_SETTINGS)
    changed = m["stg_orders"].where("order_date between '1996-03-05' and '1996-04-02'")
    got = order_rows(m, changed)
    plan = plan_of(got)
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
    assert sum("order_month" in f and "1996-03-01" in f for f in filters) == 2
    whole = Models(spark, feeds, DRIVER_SETTINGS)
    assert sorted(map(str, got.collect())) == sorted(map(str, order_rows(whole, changed).collect()))


def test_bucketed_feeds_need_no_shuffle_on_order_id(spark):
    m = models(spark)
    stored = write_bucketed_feeds(spark, m.raw, 4)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        bucketed = Models(spark, stored, m.settings)
        plan = plan_of(bucketed.derived_net_orders)
    assert "hashpartitioning(order_id" not in plan
    assert "hashpartitioning(order_id" in plan_of(m.derived_net_orders)
