"""Fixed schemas of the eight raw tables and the source registry (SRC2).

The reference infers types from CSV files; we pin them, so a scan never needs
an inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


S, D, I = T.StringType(), T.DateType(), T.IntegerType()

SALES_REPS = _schema(
    ("rep_id", S, False), ("name", S, True), ("region", S, True),
    ("quota_quarterly", I, True), ("hire_date", D, True))

ACCOUNTS = _schema(
    ("account_id", S, False), ("company_name", S, True), ("segment", S, True),
    ("industry", S, True), ("region", S, True), ("arr", MONEY, True),
    ("signup_date", D, True))

LEADS = _schema(
    ("lead_id", S, False), ("segment", S, True), ("lead_source", S, True),
    ("status", S, True), ("created_at", D, True))

OPPORTUNITIES = _schema(
    ("opp_id", S, False), ("lead_id", S, True), ("account_id", S, True),
    ("rep_id", S, True), ("segment", S, True), ("lead_source", S, True),
    ("plan", S, True), ("stage", S, True), ("amount", MONEY, True),
    ("created_date", D, True), ("close_date", D, True))

SUBSCRIPTIONS = _schema(
    ("sub_id", S, False), ("account_id", S, True), ("opp_id", S, True),
    ("plan", S, True), ("mrr", MONEY, True), ("start_date", D, True),
    ("end_date", D, True), ("status", S, True))

REVENUE_EVENTS = _schema(
    ("event_id", S, False), ("account_id", S, True), ("sub_id", S, True),
    ("type", S, True), ("amount", MONEY, True), ("event_date", D, True))

CUSTOMER_HEALTH_SCORES = _schema(
    ("health_id", S, False), ("account_id", S, True), ("sub_id", S, True),
    ("snapshot_date", D, True), ("usage_score", I, True),
    ("login_frequency_30d", I, True), ("support_tickets_30d", I, True),
    ("days_to_renewal", I, True), ("health_score", T.DecimalType(5, 1), True),
    ("risk_tier", S, True))

RETENTION_EXPERIMENTS = _schema(
    ("experiment_id", S, False), ("account_id", S, True), ("sub_id", S, True),
    ("risk_tier_at_assignment", S, True), ("variant", S, True),
    ("treatment_type", S, True), ("assigned_date", D, True),
    ("pre_experiment_mrr", MONEY, True), ("outcome", S, True),
    ("renewal_mrr", MONEY, True))

# Registry in load (dependency) order: parents before children (SNK3).
RAW_TABLES: dict[str, T.StructType] = {
    "sales_reps": SALES_REPS,
    "accounts": ACCOUNTS,
    "leads": LEADS,
    "opportunities": OPPORTUNITIES,
    "subscriptions": SUBSCRIPTIONS,
    "revenue_events": REVENUE_EVENTS,
    "customer_health_scores": CUSTOMER_HEALTH_SCORES,
    "retention_experiments": RETENTION_EXPERIMENTS,
}

LOAD_ORDER = list(RAW_TABLES)

# The tables a table's rows refer to: loaded before it (SNK3).
PARENTS: dict[str, list[str]] = {
    "opportunities": ["leads", "accounts", "sales_reps"],
    "subscriptions": ["opportunities", "accounts"],
    "revenue_events": ["subscriptions"],
    "customer_health_scores": ["subscriptions"],
    "retention_experiments": ["subscriptions"],
}

# Raw tables joined on a key by the library (JN1: health snapshot -> its
# subscription; an opportunity and the revenue events of its order). Bucketing
# both by that key, with the same bucket count, lets the join run as a
# sort-merge join without a shuffle on either side.
JOIN_KEYS: dict[str, str] = {
    "opportunities": "opp_id",
    "subscriptions": "sub_id",
    "revenue_events": "sub_id",
    "customer_health_scores": "sub_id",
}
