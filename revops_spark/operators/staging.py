"""Staging layer (STG1-STG8): one projection per raw table.

Each is a lazy `select`: no filter, no cast. Column pruning and predicate
pushdown from the marts above pass straight through into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _project(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def stg_accounts(raw: DataFrame) -> DataFrame:
    return _project(raw, "account_id", "company_name", "segment", "industry", "region",
                    "arr", "signup_date")


def stg_customer_health_scores(raw: DataFrame) -> DataFrame:
    return _project(raw, "health_id", "account_id", "sub_id", "snapshot_date", "usage_score",
                    "login_frequency_30d", "support_tickets_30d", "days_to_renewal",
                    "health_score", "risk_tier")


def stg_leads(raw: DataFrame) -> DataFrame:
    return _project(raw, "lead_id", "segment", "lead_source", "status", "created_at")


def stg_opportunities(raw: DataFrame) -> DataFrame:
    return _project(raw, "opp_id", "lead_id", "account_id", "rep_id", "segment", "lead_source",
                    "plan", "stage", "amount", "created_date", "close_date")


def stg_retention_experiments(raw: DataFrame) -> DataFrame:
    return _project(raw, "experiment_id", "account_id", "sub_id", "risk_tier_at_assignment",
                    "variant", "treatment_type", "assigned_date", "pre_experiment_mrr",
                    "outcome", "renewal_mrr")


def stg_revenue_events(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", "account_id", "sub_id", F.col("type").alias("event_type"),
                      "amount", "event_date")


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    return _project(raw, "sub_id", "account_id", "opp_id", "plan", "mrr", "start_date",
                    "end_date", "status")


def stg_sales_reps(raw: DataFrame) -> DataFrame:
    return raw.select("rep_id", F.col("name").alias("rep_name"), "region", "quota_quarterly",
                      "hire_date")


# raw table name -> staging model
STAGING = {
    "accounts": stg_accounts,
    "customer_health_scores": stg_customer_health_scores,
    "leads": stg_leads,
    "opportunities": stg_opportunities,
    "retention_experiments": stg_retention_experiments,
    "revenue_events": stg_revenue_events,
    "subscriptions": stg_subscriptions,
    "sales_reps": stg_sales_reps,
}
