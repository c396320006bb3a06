"""Registered queries: adapter -> staging -> mart, one callable per key.

Each takes (spark, sf_dir) and returns a lazy DataFrame over the whole input
tables. `report` fixes the presentation types (dates as ISO text, money as
double, statistics to 10 decimals, sample sizes to 4) so results compare
exactly across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import experiments as ex
from ..operators import lifecycle as lc
from ..operators import marts as m
from ..operators import staging as stg
from ..sources import files, layout
from ..sources import testdata as td
from . import build

Query = Callable[[SparkSession, str], DataFrame]

STAT_DIGITS = 10
SAMPLE_SIZE_DIGITS = 4  # sample sizes grow as 1/h^2; 10 decimals would exceed double precision


def report(df: DataFrame, round_doubles: bool = False,
           digits: dict[str, int] | None = None) -> DataFrame:
    """Dates -> ISO 'yyyy-MM-dd' text, decimals -> double; optionally round doubles
    (to STAT_DIGITS, or to `digits[name]` for the named columns)."""
    digits = digits or {}
    exprs = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        e = name
        if isinstance(f.dataType, T.DateType):
            e = f"CAST({name} AS STRING)"  # ISO yyyy-MM-dd
        elif isinstance(f.dataType, T.DecimalType):
            e = f"CAST({name} AS DOUBLE)"
        elif round_doubles and isinstance(f.dataType, T.DoubleType):
            e = f"round({name}, {digits.get(f.name, STAT_DIGITS)})"
        exprs.append(f"{e} AS {name}")
    return df.selectExpr(*exprs)


# --- leads --------------------------------------------------------------------
def _leads(spark, d, statuses=None, with_segment=True):
    """STG3 over the events; each mart's plan reads and shuffles only the columns
    the mart names."""
    return stg.stg_leads(td.leads(spark, d, statuses, with_segment))


def leads_funnel(spark, d):
    """STG3, MRT1."""
    return report(m.fct_leads_funnel(_leads(spark, d)))


def conversion_rates(spark, d):
    """STG3, MRT2, SC2, SC3."""
    return report(m.agg_conversion_rates(_leads(spark, d)))


def qualified_leads(spark, d):
    """STG3, FLT2 (the status filter also on the raw event types)."""
    return report(m.qualified_leads(_leads(spark, d, m.SQL_OR_LATER)))


def data_quality(spark, d):
    """STG3, MRT6, SC12."""
    return report(m.audit_data_quality_summary(_leads(spark, d)))


def kpi_scorecard(spark, d):
    """STG3, MRT7."""
    return report(m.kpi_scorecard(_leads(spark, d)))


def funnel_long(spark, d):
    """STG3, MRT8 (no segment, so no customer join)."""
    return report(m.funnel_long(_leads(spark, d, with_segment=False)))


# --- opportunities and revenue ----------------------------------------------------
def _closed(spark, d):
    """STG4 over the closed orders (FLT1 also on the raw order status)."""
    return stg.stg_opportunities(td.opportunities(spark, d, m.CLOSED_STAGES))


def sales_cycle(spark, d):
    """STG4, FLT1, MRT3, SC4, SC6."""
    return report(m.agg_sales_cycle(_closed(spark, d)))


def win_rate(spark, d):
    """STG4, FLT1, MRT9."""
    return report(m.win_rate(_closed(spark, d)))


def mrr_waterfall(spark, d):
    """STG6, MRT4, AGG7, SC5, SRT1."""
    return report(m.fct_mrr_waterfall(stg.stg_revenue_events(td.revenue_events(spark, d))))


# --- experiment -----------------------------------------------------------------
def _ab_mart(spark, d, sort=False):
    return m.fct_churn_ab_test_results(
        stg.stg_retention_experiments(td.retention_experiments(spark, d)), sort=sort)


def churn_ab_results(spark, d):
    """STG5, MRT5, SRT2."""
    return report(_ab_mart(spark, d, sort=True))


def ab_significance(spark, d):
    """ST1-ST4, ST7, ST8, MRT10, AGG9 over MRT5."""
    return report(ex.ab_significance(_ab_mart(spark, d)), round_doubles=True)


def ab_power(spark, d):
    """ST5, ST6 (solved with both tails), ST7 over MRT5."""
    return report(ex.ab_power(_ab_mart(spark, d)), round_doubles=True,
                  digits={"required_n_per_group": SAMPLE_SIZE_DIGITS})


def experiment_outcomes(spark, d):
    """BR9."""
    exps = ex.experiment_outcomes(stg.stg_retention_experiments(td.retention_experiments(spark, d)))
    return report(exps.select("experiment_id", "outcome", "pre_experiment_mrr", "renewal_mrr"))


# --- lifecycle rules ----------------------------------------------------------
def subscriptions_from_wins(spark, d):
    """BR1, BR2, FLT3."""
    return report(td.subscriptions(spark, d))


def health_snapshots(spark, d):
    """BR6."""
    return report(td.snapshots(spark, d))


def revenue_events_from_subs(spark, d):
    """BR3."""
    return report(td.lifecycle_revenue_events(spark, d))


def health_scores(spark, d):
    """BR4, BR5."""
    return report(lc.score_accounts(td.account_activity(spark, d)))


def experiment_assignment(spark, d):
    """BR7, BR8, FLT4, JN1."""
    subs = td.subscriptions(spark, d)
    health = stg.stg_customer_health_scores(td.health(spark, d, subs))
    eligible = ex.eligible_for_experiment(health, stg.stg_subscriptions(subs))
    return report(ex.build_experiments(eligible, "sub_id", td.EXPERIMENT_SALT))


# --- through files and catalogue tables ----------------------------------------
def leads_csv_round_trip(spark, d):
    """SRC1, SC8, SNK1, SNK4: all leads written as CSV and read back by header.

    The file has its columns in another order and case; the sources hold commas,
    quotes and line ends, and some are blank.
    """
    leads = td.leads(spark, d)
    said = F.concat_ws("\n", F.concat("lead_source", F.lit(', "'), "status", F.lit('"')), "segment")
    leads = leads.withColumn("lead_source", F.when(F.col("lead_source") == "", "").otherwise(said))
    path = f"{files.shared_folder(spark)}/{uuid.uuid4().hex}/leads.csv"
    files.export_csv(leads.select(*[F.col(c).alias(c.upper()) for c in reversed(leads.columns)]), path,
                     mode="errorifexists")
    return report(stg.stg_leads(files.read_csv_table(spark, path, "leads")))


def churn_ab_from_tables(spark, d):
    """SRC2, SRC4, SNK2, SNK3, SNK5-SNK7: MRT5 as read from the mart that load and
    build wrote, from CSV files of all eight raw tables over catalogue tables and
    staging views. The raw tables are dropped again. Three adapters share one
    roll-up of the line items, of which they use two dates."""
    run = uuid.uuid4().hex[:12]
    folder = f"{files.shared_folder(spark)}/{run}"
    rolled = layout.store_rollup(spark, d, f"{folder}-lines", ["last_ship", "cancelled_on"])
    raw = {name: adapter(spark, rolled) for name, adapter in td.RAW_ADAPTERS.items()}
    build.load_and_build(spark, raw, folder, f"raw_{run}", f"mart_{run}")
    spark.sql(f"DROP SCHEMA raw_{run} CASCADE")
    return report(files.fetch_ab_test_data(spark, f"mart_{run}"))


# --- staging models over every adapter ---------------------------------------
def _staged(name: str) -> Query:
    def run(spark, d):
        """STG1-STG8: the staging projection over its adapter."""
        return report(stg.STAGING[name](td.RAW_ADAPTERS[name](spark, d)))
    run.__name__ = f"stg_{name}"
    return run


# run several jobs and write files and tables before they return
MULTI_STEP = ["leads_csv_round_trip", "churn_ab_from_tables"]

QUERIES: dict[str, Query] = {
    "leads_funnel": leads_funnel,
    "conversion_rates": conversion_rates,
    "qualified_leads": qualified_leads,
    "data_quality": data_quality,
    "kpi_scorecard": kpi_scorecard,
    "funnel_long": funnel_long,
    "sales_cycle": sales_cycle,
    "win_rate": win_rate,
    "mrr_waterfall": mrr_waterfall,
    "churn_ab_results": churn_ab_results,
    "ab_significance": ab_significance,
    "ab_power": ab_power,
    "experiment_outcomes": experiment_outcomes,
    "subscriptions_from_wins": subscriptions_from_wins,
    "health_snapshots": health_snapshots,
    "revenue_events_from_subs": revenue_events_from_subs,
    "health_scores": health_scores,
    "experiment_assignment": experiment_assignment,
    "leads_csv_round_trip": leads_csv_round_trip,
    "churn_ab_from_tables": churn_ab_from_tables,
    **{f"stg_{name}": _staged(name) for name in stg.STAGING},
}
