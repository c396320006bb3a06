"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import os

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_ORACLE
from duckdb_oracle import ORACLE_SQL as ORACLE
from oracle_check import compare, duck
from revops_spark.plans.queries import QUERIES

SF = os.environ.get("REVOPS_ORACLE_SF", SF_ORACLE)   # the scale of the correctness gate


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns[:2] == ["stratum", "is_overall"]


def test_adapter_mix_at_sf001(spark):
    """The adapter mixes recorded in FIXTURES.md at sf 0.01."""
    from pyspark.sql import functions as F
    from revops_spark.sources import testdata as td
    exp = td.retention_experiments(spark, SF_ORACLE)
    mix = {(r.risk_tier_at_assignment, r.variant): r["count"]
           for r in exp.groupBy("risk_tier_at_assignment", "variant").count().collect()}
    assert mix == {("high_risk", "control"): 2782, ("high_risk", "treatment"): 2812,
                   ("watch", "control"): 2579, ("watch", "treatment"): 2577}
    leads = td.leads(spark, SF_ORACLE)
    assert leads.count() == 10000
    assert leads.filter(F.col("lead_source") == "").count() == 1125
    from revops_spark.operators import lifecycle as lc
    from revops_spark.operators import marts as m
    tiers = {r.risk_tier: r["count"] for r in
             lc.score_accounts(td.account_activity(spark, SF_ORACLE)).groupBy("risk_tier").count().collect()}
    assert tiers == {"high_risk": 14, "watch": 108, "healthy": 28}
    cycles = m.agg_sales_cycle(td.opportunities(spark, SF_ORACLE)).agg(
        F.sum("total_closed_deals").alias("n"), F.min("min_sales_cycle_days").alias("lo"),
        F.max("max_sales_cycle_days").alias("hi")).first()
    assert td.health(spark, SF_ORACLE).count() == td.subscriptions(spark, SF_ORACLE).count() == 4933
    assert (cycles.n, cycles.lo, cycles.hi) == (9912, 0, 2478)
    events = td.revenue_events(spark, SF_ORACLE)
    assert events.count() == 60000
    assert m.fct_mrr_waterfall(events.withColumnRenamed("type", "event_type")).count() == 83
