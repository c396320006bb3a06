"""Mart layer (MRT1-MRT9): the metric models.

Every mart is one aggregate over one staging relation. The two marts whose
model ends in ORDER BY take `sort`: the order only matters where a result is
presented, so the build (tables keep no order) and the A/B statistics (which
re-aggregate) skip that range exchange. Group keys are
low-cardinality (segment, source, month, variant x tier), so Spark's partial
aggregation collapses each input partition to a handful of rows before the
shuffle: a hot key costs nothing, and the exchange carries only partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (count_where, days_between, is_blank, month_of, pct,
                               round_ratio, total_money)

# --- fixed values: lead statuses, opportunity stages, event types ----------
MQL_OR_LATER = ["MQL", "SQL", "Opportunity"]
SQL_OR_LATER = ["SQL", "Opportunity"]
OPPORTUNITY = "Opportunity"
CLOSED_STAGES = ["Closed Won", "Closed Lost"]
WON_STAGE = "Closed Won"
EVENT_NEW, EVENT_EXPANSION, EVENT_CHURN = "new", "expansion", "churn"
# ---------------------------------------------------------------------------


def tally(predicate: Column | None = None, weight: str | None = None) -> Column:
    """`count(*)` or `count(case when p then 1 end)`; with `weight`, the same
    counts over pre-aggregated rows, each standing for `weight` rows. 0, never
    NULL, either way."""
    if weight is None:
        return F.count(F.lit(1)) if predicate is None else count_where(predicate)
    w = F.col(weight)
    total = F.sum(w) if predicate is None else F.sum(F.when(predicate, w))
    return F.coalesce(total, F.lit(0)).cast("bigint")


def _stage_counts(status: Column, weight: str | None = None) -> list[Column]:
    """Cumulative funnel: an MQL count includes leads that went further."""
    return [
        tally(None, weight).alias("total_leads"),
        tally(status.isin(MQL_OR_LATER), weight).alias("mql_count"),
        tally(status.isin(SQL_OR_LATER), weight).alias("sql_count"),
        tally(status == OPPORTUNITY, weight).alias("opportunity_count"),
    ]


# The lead marts accept `weight`: the name of a count column when the leads
# arrive pre-aggregated (one row per distinct attribute combination). Rolling a
# fact table up before it is joined to a dimension shrinks that join's shuffle
# from one row per lead to one row per combination, and one roll-up can feed
# every lead mart.

LEAD_ATTRIBUTES = ["segment", "lead_source", "status", "created_at"]


def lead_tallies(leads: DataFrame, weight_name: str = "n") -> DataFrame:
    """Leads rolled up to their distinct (segment, lead_source, status,
    created_at) combinations with the number of leads in each; every lead mart
    gives the same result on this with `weight=weight_name`."""
    return leads.groupBy(*LEAD_ATTRIBUTES).agg(F.count(F.lit(1)).alias(weight_name))


def fct_leads_funnel(leads: DataFrame, weight: str | None = None) -> DataFrame:
    """MRT1: segment, total_leads, mql_count, sql_count, opportunity_count."""
    return leads.groupBy("segment").agg(*_stage_counts(F.col("status"), weight))


def agg_conversion_rates(leads: DataFrame, weight: str | None = None) -> DataFrame:
    """MRT2: the funnel by segment and source, with step rates over the previous stage.

    A NULL and an empty-string lead_source are two different groups.
    """
    counts = leads.groupBy("segment", "lead_source").agg(
        *_stage_counts(F.col("status"), weight))
    return counts.select(
        "segment", "lead_source", "total_leads", "mql_count", "sql_count", "opportunity_count",
        pct("mql_count", "total_leads").alias("lead_to_mql_pct"),
        pct("sql_count", "mql_count").alias("mql_to_sql_pct"),
        pct("opportunity_count", "sql_count").alias("sql_to_opp_pct"),
    )


def qualified_leads(leads: DataFrame) -> DataFrame:
    """FLT2: leads at SQL or Opportunity status (those that become opportunities)."""
    return leads.filter(F.col("status").isin(SQL_OR_LATER))


def closed_deals(opps: DataFrame) -> DataFrame:
    """FLT1: won and lost deals; open ones are excluded."""
    return opps.filter(F.col("stage").isin(CLOSED_STAGES))


def agg_sales_cycle(opps: DataFrame) -> DataFrame:
    """MRT3: segment, total_closed_deals, avg (1 decimal) / min / max sales_cycle_days."""
    days = days_between("created_date", "close_date")
    deals = closed_deals(opps).select("segment", days.alias("sales_cycle_days"))
    return deals.groupBy("segment").agg(
        F.count(F.lit(1)).alias("total_closed_deals"),
        round_ratio("sum(sales_cycle_days)", "count(sales_cycle_days)", 1)
        .alias("avg_sales_cycle_days"),
        F.min("sales_cycle_days").alias("min_sales_cycle_days"),
        F.max("sales_cycle_days").alias("max_sales_cycle_days"),
    )


def win_rate(opps: DataFrame) -> DataFrame:
    """MRT9: segment, lead_source, won_deals, closed_deals, win_rate_pct = won / (won + lost)."""
    deals = closed_deals(opps)
    return deals.groupBy("segment", "lead_source").agg(
        count_where(F.col("stage") == WON_STAGE).alias("won_deals"),
        F.count(F.lit(1)).alias("closed_deals"),
    ).withColumn("win_rate_pct", pct("won_deals", "closed_deals"))


def fct_mrr_waterfall(events: DataFrame, sort: bool = True) -> DataFrame:
    """MRT4: event_month, new_mrr, expansion_mrr, churned_mrr, net_mrr_change.

    The reference sums per (month, type) and then pivots with conditional sums;
    one conditional-sum aggregate per month gives the same values (unknown types
    count as 0, a month made only of one type's NULL amounts gives NULL) with a
    single exchange. Churn amounts are already negative, so net is a plain sum.
    """
    amount, etype = F.col("amount"), F.col("event_type")

    def by_type(t: str) -> Column:
        return total_money(F.when(etype == t, amount).otherwise(F.lit(0)))

    monthly = events.groupBy(month_of("event_date").alias("event_month")).agg(
        by_type(EVENT_NEW).alias("new_mrr"),
        by_type(EVENT_EXPANSION).alias("expansion_mrr"),
        by_type(EVENT_CHURN).alias("churned_mrr"),
    )
    net = (F.col("new_mrr") + F.col("expansion_mrr") + F.col("churned_mrr")).cast("decimal(38,2)")
    out = monthly.withColumn("net_mrr_change", net)
    return out.orderBy(F.col("event_month").asc_nulls_last()) if sort else out


def fct_churn_ab_test_results(experiments: DataFrame, sort: bool = True) -> DataFrame:
    """MRT5: one row per variant x risk tier; total_accounts counts experiment rows."""
    outcome = F.col("outcome")
    out = (
        experiments.groupBy("variant", "risk_tier_at_assignment").agg(
            F.count(F.lit(1)).alias("total_accounts"),
            count_where(outcome == "churned").alias("churned_count"),
            count_where(outcome == "renewed").alias("renewed_count"),
            total_money("pre_experiment_mrr").alias("total_pre_experiment_mrr"),
            total_money("renewal_mrr").alias("total_retained_mrr"),
        )
        .withColumn("churn_rate_pct", pct("churned_count", "total_accounts"))
        .select("variant", "risk_tier_at_assignment", "total_accounts", "churned_count",
                "renewed_count", "churn_rate_pct", "total_pre_experiment_mrr",
                "total_retained_mrr")
    )
    if not sort:
        return out
    return out.orderBy(F.col("risk_tier_at_assignment").asc_nulls_last(),
                       F.col("variant").asc_nulls_last())


def audit(df: DataFrame, checks: dict[str, Column], total_name: str = "total_rows",
          weight: str | None = None) -> DataFrame:
    """Generalised data-quality audit: one row, a count per failed check.

    issue_rate_pct = issues / (rows x checks), data_quality_score_pct =
    100 - that rate, each rounded on its own; NULL rates for an empty input.
    """
    counts = df.agg(tally(None, weight).alias(total_name),
                    *[tally(pred, weight).alias(name) for name, pred in checks.items()])
    issues, cells = _issues_and_cells(checks, total_name)
    return counts.select(
        total_name, *checks,
        F.expr(issues).alias("total_issues"),
        pct(issues, cells).alias("issue_rate_pct"),
        pct(f"{cells} - ({issues})", cells).alias("data_quality_score_pct"),
    )


def _issues_and_cells(checks: dict[str, Column], total_name: str) -> tuple[str, str]:
    """SQL text: the sum of the failed-check counts, and rows x checks."""
    return " + ".join(checks) or "CAST(0 AS BIGINT)", f"{total_name} * {len(checks)}"


def lead_quality_checks() -> dict[str, Column]:
    return {
        "missing_lead_source_count": is_blank("lead_source"),
        "missing_segment_count": is_blank("segment"),
        "missing_created_at_count": F.col("created_at").isNull(),
    }


def audit_data_quality_summary(leads: DataFrame, weight: str | None = None) -> DataFrame:
    """MRT6: total_leads, 3 missing counts, total_issues, issue_rate_pct, data_quality_score_pct."""
    return audit(leads, lead_quality_checks(), total_name="total_leads", weight=weight)


def kpi_scorecard(leads: DataFrame, weight: str | None = None) -> DataFrame:
    """MRT7: total_leads, opportunity_count, data_quality_score, missing_lead_source_count.

    One global aggregate over the leads (no join of one-row frames).
    Opportunity count = leads at Opportunity status.
    """
    checks = lead_quality_checks()
    counts = leads.agg(
        tally(None, weight).alias("total_leads"),
        tally(F.col("status") == OPPORTUNITY, weight).alias("opportunity_count"),
        *[tally(pred, weight).alias(name) for name, pred in checks.items()],
    )
    issues, cells = _issues_and_cells(checks, "total_leads")
    return counts.select(
        "total_leads", "opportunity_count",
        pct(f"{cells} - ({issues})", cells).alias("data_quality_score"),
        "missing_lead_source_count",
    )


FUNNEL_STAGES = [("Lead", "total_leads"), ("MQL", "mql_count"), ("SQL", "sql_count"),
                 ("Opportunity", "opportunity_count")]


def funnel_long(leads: DataFrame, weight: str | None = None) -> DataFrame:
    """MRT8: the lead-to-opportunity funnel in long form: stage_order, stage, n."""
    totals = leads.agg(*_stage_counts(F.col("status"), weight))
    stages = F.array(*[
        F.struct(F.lit(i + 1).alias("stage_order"), F.lit(label).alias("stage"),
                 F.col(column).alias("n"))
        for i, (label, column) in enumerate(FUNNEL_STAGES)])
    return totals.select(F.inline(stages))
