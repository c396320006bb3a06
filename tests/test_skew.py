"""A key holding a third of all rows: the join is split by AQE, never trimmed."""

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import functions as F

import pytest

from revops_spark.operators import lifecycle as lc

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_account_join_is_split_not_dropped(spark):
    n = 30000
    subs = spark.range(n).select(
        F.col("id").cast("string").alias("sub_id"),
        # a third of all subscriptions belong to account "hot"
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string"))
        .alias("account_id"),
        F.lit("o").alias("opp_id"), F.lit("p").alias("plan"),
        F.lit(10).cast("decimal(18,2)").alias("mrr"),
        F.lit(dt.date(2025, 1, 1)).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"), F.lit("active").alias("status"))
    activity = spark.range(500).select(
        F.col("id").cast("string").alias("account_id"), F.lit(50).alias("usage_score"),
        F.lit(10).alias("login_frequency_30d"), F.lit(1).alias("support_tickets_30d")
    ).unionByName(spark.createDataFrame([("hot", 90, 20, 0)],
                                        "account_id string, usage_score int, "
                                        "login_frequency_30d int, support_tickets_30d int"))
    with conf(spark, SKEW_CONF):
        health = lc.customer_health_scores(subs, activity, dt.date(2026, 6, 30), 90)
        # a downstream aggregate on another key, as in the marts: splitting the
        # hot partition then costs no extra shuffle, so AQE applies it
        per_tier = health.groupBy("risk_tier", (F.col("account_id") == "hot").alias("hot")).count()
        rows = {(r.risk_tier, r.hot): r["count"] for r in per_tier.collect()}
        plan = per_tier._jdf.queryExecution().executedPlan().toString()
    assert sum(rows.values()) == n                     # every row kept
    assert rows[("healthy", True)] == n // 3
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """Orders, line items, customers and events in which customer 7 has a third
    of all rows."""
    n, out = 60_000, str(tmp_path_factory.mktemp("hot"))
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).cast("long")
    day = F.timestamp_add("DAY", F.col("id") % 900, F.lit("1995-01-01").cast("timestamp_ntz"))
    tables = {
        "orders": spark.range(n).select(
            F.col("id").alias("o_orderkey"), hot.alias("o_custkey"),
            F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int"))
            .alias("o_orderstatus"),
            (F.col("id") % 1000 + 0.5).cast("double").alias("o_totalprice"),
            day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(n).select(
            F.col("id").alias("l_orderkey"), F.lit(1).cast("long").alias("l_partkey"),
            F.lit(1).cast("long").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
            *[F.lit(1.0).alias(f"l_{c}") for c in ("quantity", "extendedprice", "discount", "tax")],
            F.element_at(F.array(*map(F.lit, "RAN")), (F.col("id") % 7 % 3 + 1).cast("int"))
            .alias("l_returnflag"), F.lit("F").alias("l_linestatus"), day.alias("l_shipdate")),
        "customer": spark.range(500).select(
            F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit(1).alias("c_nationkey"),
            F.lit(10.0).alias("c_acctbal"), F.lit("SMB").alias("c_mktsegment")),
        "events": spark.range(n).select(
            F.col("id").alias("event_id"), day.alias("ts"), hot.alias("user_id"),
            F.element_at(F.array(*map(F.lit, ["view", "click", "signup", "purchase", "error"])),
                         (F.col("id") % 5 + 1).cast("int")).alias("event_type"),
            F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{out}/{name}.parquet")
    return out


# orders of the hot customer all have status F; events are dealt evenly
@pytest.mark.parametrize("name, total, want", [
    ("win_rate", "closed_deals", 40_000), ("sales_cycle", "total_closed_deals", 40_000),
    ("leads_funnel", "total_leads", 60_000), ("conversion_rates", "total_leads", 60_000),
])
def test_hot_customer_is_split_with_all_rows_kept(spark, hot_dir, name, total, want):
    from revops_spark.plans.queries import QUERIES
    with conf(spark, SKEW_CONF):
        df = QUERIES[name](spark, hot_dir)
        assert sum(r[total] for r in df.collect()) == want
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan, plan


def test_hot_account_join_over_the_activity_adapter_is_split(spark, hot_dir):
    """The health join as the queries run it, over account_activity's key."""
    from revops_spark.sources import testdata as td
    with conf(spark, SKEW_CONF):
        per_tier = td.health(spark, hot_dir).groupBy("risk_tier").count()
        assert sum(r["count"] for r in per_tier.collect()) == 20_000
        plan = per_tier._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan, plan
