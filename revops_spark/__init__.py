"""revops_spark: go-to-market and revenue-operations metrics as Spark DataFrame transforms."""

from .operators.experiments import (ab_power, ab_significance, assign_variant,
                                    build_experiments, eligible_for_experiment,
                                    experiment_outcomes, renewal_mrr)
from .operators.lifecycle import (customer_health_scores, derive_revenue_events,
                                  derive_subscriptions, health_score, health_snapshots,
                                  risk_tier, score_accounts, subscription_status)
from .operators.marts import (agg_conversion_rates, agg_sales_cycle, audit,
                              audit_data_quality_summary, fct_churn_ab_test_results,
                              fct_leads_funnel, fct_mrr_waterfall, funnel_long, kpi_scorecard,
                              lead_tallies, qualified_leads, tally, win_rate)
from .operators.staging import STAGING

__all__ = [
    "ab_power", "ab_significance", "assign_variant", "build_experiments",
    "eligible_for_experiment", "experiment_outcomes", "renewal_mrr", "customer_health_scores",
    "derive_revenue_events", "derive_subscriptions", "health_score", "health_snapshots",
    "risk_tier", "score_accounts", "subscription_status", "agg_conversion_rates",
    "agg_sales_cycle", "audit", "audit_data_quality_summary", "fct_churn_ab_test_results",
    "fct_leads_funnel", "fct_mrr_waterfall", "funnel_long", "kpi_scorecard", "lead_tallies",
    "qualified_leads", "tally", "win_rate", "STAGING",
]
