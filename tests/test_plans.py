"""Plan properties that must hold at any scale (checked on the physical plan)."""

import pytest

from conftest import SF_SMALL
from revops_spark.plans.queries import QUERIES


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, name):
    """The text of `explain("formatted")`."""
    df = QUERIES[name](spark, SF_SMALL)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_win_rate_never_reads_lineitem(spark):
    assert "lineitem" not in formatted(spark, "win_rate")


def test_balance_filter_reaches_the_scan(spark):
    assert "LessThan(c_acctbal,7000.0)" in formatted(spark, "churn_ab_results")


def test_waterfall_prunes_columns_and_shuffles_partials_once(spark):
    text = formatted(spark, "mrr_waterfall")
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text
    plan = plan_of(spark, "mrr_waterfall")
    assert plan.count("partial_sum") == 3                  # map-side combine before the exchange
    assert plan.count("Exchange hashpartitioning") == 1


LEAD_MARTS = ["leads_funnel", "conversion_rates", "data_quality", "kpi_scorecard"]


@pytest.mark.parametrize("name", LEAD_MARTS)
def test_lead_marts_shuffle_events_once_on_the_user(spark, name):
    """One exchange per join side (no customer table is small enough to be
    broadcast here), then the partials; no exchange before the one on user_id."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    events_side = plan[:plan.index("events.parquet")] if "events.parquet" in plan else plan
    assert plan.count("Exchange hashpartitioning(user_id") == 2, plan
    assert events_side.count("Exchange") <= 3


@pytest.mark.parametrize("name, columns", [
    ("leads_funnel", "user_id:bigint,event_type:string"),
    ("conversion_rates", "user_id:bigint,event_type:string,props:string"),
    ("data_quality", "ts:timestamp_ntz,user_id:bigint,props:string"),
    ("kpi_scorecard", "ts:timestamp_ntz,user_id:bigint,event_type:string,props:string"),
    ("funnel_long", "event_type:string"),
])
def test_lead_marts_read_only_what_they_use(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in formatted(spark, name)


def test_funnel_long_has_no_customer_join(spark):
    assert "customer.parquet" not in formatted(spark, "funnel_long")


@pytest.mark.parametrize("name, pushed", [
    ("qualified_leads", "In(event_type, [purchase,signup])"),
    ("sales_cycle", "In(o_orderstatus, [F,O])"),
    ("win_rate", "In(o_orderstatus, [F,O])"),
    ("subscriptions_from_wins", "EqualTo(o_orderstatus,F)"),
    ("stg_subscriptions", "EqualTo(o_orderstatus,F)"),
    ("experiment_assignment", "EqualTo(o_orderstatus,F)"),
])
def test_stage_and_status_filters_reach_the_scan(spark, name, pushed):
    assert pushed in formatted(spark, name)


def test_subscriptions_never_read_customers(spark):
    text = formatted(spark, "subscriptions_from_wins")
    assert "customer.parquet" not in text and "orders.parquet" in text
