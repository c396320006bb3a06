"""Adapters: the eight RevOps inputs derived from the shared TPC-H-style tables.

The reference ships only one of its eight inputs, so each input is mapped
from `/root/testdata/sf*/` by a fixed rule (see FIXTURES.md section 4). Every
adapter is a lazy plan over Parquet scans: filters and column pruning reach
the scan, and each join is an equi-join that AQE may turn into a broadcast
only when the runtime size of one side is under the broadcast threshold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import count_where, keys_of, lookup, money
from ..operators.experiments import assign_variant, renewal_mrr
from ..operators.lifecycle import (WON_STAGE, customer_health_scores, derive_revenue_events,
                                   derive_subscriptions, health_snapshots)

# --- fixed values -----------------------------------------------------------
# lead sources of the reference, picked by k % 9 (k from events.props);
# 8 gives a blank source
LEAD_SOURCES = ["Paid Search", "Organic Search", "Content Download", "Partner Referral",
                "Compliance Webinar", "Outbound Prospecting", "G2/Capterra Review",
                "Security Conference"]
EVENT_TO_STATUS = {"view": "New", "click": "MQL", "signup": "SQL", "purchase": "Opportunity",
                   "error": "Disqualified"}
ORDER_STATUS_TO_STAGE = {"F": "Closed Won", "O": "Closed Lost", "P": "Negotiation"}
RETURN_FLAG_TO_EVENT = {"N": "new", "A": "expansion", "R": "churn"}
RETURNED, ACCEPTED = "R", "A"             # return flags of a line item
BLANK_PRIORITY = "4-NOT SPECIFIED"
DEFAULT_PLAN = "SOC2 Starter"
AS_OF = dt.date(2001, 12, 31)             # end of the order history
ACTIVITY_SINCE = dt.date(2024, 1, 17)     # logins / tickets window start
ACTIVITY_UNTIL = dt.date(2024, 1, 30)     # last day of the event history
TERM_MONTHS = 12                          # a change to a subscription waits for its term
ELIGIBLE_BALANCE = 7000                   # customers below it are at risk
EXPERIMENT_SALT = "exp1"
# ---------------------------------------------------------------------------


# Layout of the shared test tables. Pinning it skips the footer-reading schema
# inference that `spark.read.parquet` would run for every table of every query.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder `sf_dir`, or of a layout that stands for one."""
    stored = getattr(sf_dir, "stored", None)
    if stored and (found := stored(spark, name)) is not None:
        return found
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def leads(spark: SparkSession, sf_dir: str, statuses: list[str] | None = None,
          with_segment: bool = True) -> DataFrame:
    """One lead per event; segment from the customer; status from the event type.

    `statuses` filters the raw event types, which reaches the scan;
    `with_segment=False` spares the customer join (segment is then NULL). A hot
    user is split by AQE: nothing stands between the join and its exchange.
    """
    ev = table(spark, sf_dir, "events")
    if statuses is not None:
        ev = ev.filter(F.col("event_type").isin(keys_of(EVENT_TO_STATUS, statuses)))
    if with_segment:
        cust = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
        ev = ev.join(cust, "user_id", "left")
    else:
        ev = ev.withColumn("segment", F.lit(None).cast("string"))
    k = "try_cast(get_json_object(props, '$.k') AS INT)"
    sources = dict(enumerate(LEAD_SOURCES)) | {len(LEAD_SOURCES): ""}
    return ev.select(
        F.col("event_id").cast("string").alias("lead_id"),
        "segment",
        lookup(f"{k} % 9", sources).alias("lead_source"),
        lookup("event_type", EVENT_TO_STATUS).alias("status"),
        F.col("ts").cast("date").alias("created_at"),
    )


def line_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, in one pass over its line items: the last shipment, when a returned
    line and an accepted one take effect (a change waits for the end of its term,
    a year after the line was shipped), and the accepted lines' yearly amount.

    What a query doesn't use of it is pruned, down to the scan. A layout that stands
    for the folder may hold it.
    """
    if rolled_up := getattr(sf_dir, "rolled_up", None):
        return rolled_up(spark)
    shipped, flag = F.col("l_shipdate"), F.col("l_returnflag")

    def effective(which):
        return F.add_months(F.max(F.when(which, shipped)).cast("date"), TERM_MONTHS)

    return (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(shipped).cast("date").alias("last_ship"),
        effective(flag == RETURNED).alias("cancelled_on"),
        effective(flag == ACCEPTED).alias("expanded_on"),
        F.sum(F.when(flag == ACCEPTED, money("l_extendedprice"))).alias("accepted_amount")))


def opportunities(spark: SparkSession, sf_dir: str, stages: list[str] | None = None,
                  with_segment: bool = True, keep: list[str] | None = None) -> DataFrame:
    """One opportunity per order; it closes at its last shipment.

    `stages` filters the raw order status, which reaches the scan;
    `with_segment=False` spares the customer join (segment is then NULL); `keep`
    names further columns of the line items' roll-up. The customer join is plain,
    so AQE splits a customer with very many orders.
    """
    orders = table(spark, sf_dir, "orders")
    if stages is not None:
        orders = orders.filter(F.col("o_orderstatus").isin(keys_of(ORDER_STATUS_TO_STAGE, stages)))
    if with_segment:
        cust = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
        orders = orders.join(cust, "o_custkey", "left")
    else:
        orders = orders.withColumn("segment", F.lit(None).cast("string"))
    created = F.col("o_orderdate").cast("date")
    close = F.greatest(created, F.coalesce(F.col("last_ship"), created))
    key, cust_key = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    priority = F.col("o_orderpriority")
    return (orders.join(line_rollup(spark, sf_dir), "o_orderkey", "left")
            .select(
                key.alias("opp_id"), key.alias("lead_id"), cust_key.alias("account_id"),
                cust_key.alias("rep_id"), "segment",
                F.when(priority == BLANK_PRIORITY, F.lit("")).otherwise(priority)
                .alias("lead_source"),
                F.lit(DEFAULT_PLAN).alias("plan"),
                lookup("o_orderstatus", ORDER_STATUS_TO_STAGE).alias("stage"),
                money("o_totalprice").alias("amount"),
                created.alias("created_date"), close.alias("close_date"), *(keep or [])))


def revenue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One revenue event per line item; returned lines are churn (negative)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_extendedprice",
        "l_shipdate")
    amount = money("l_extendedprice")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("l_suppkey").cast("string").alias("account_id"),
        F.col("l_orderkey").cast("string").alias("sub_id"),
        lookup("l_returnflag", RETURN_FLAG_TO_EVENT).alias("type"),
        F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).alias("amount"),
        F.col("l_shipdate").cast("date").alias("event_date"),
    )


def at_risk_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT4 on raw balances: the customers whose orders are experiment units."""
    return table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < ELIGIBLE_BALANCE)


def retention_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of at-risk customers are the experiment units.

    Tier by balance; arm by the deterministic md5 split (BR8); a unit with a
    returned line item has churned, as a subscription has.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cust = at_risk_customers(spark, sf_dir).select(
        F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    returned = (table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == RETURNED)
                .select(F.col("l_orderkey").alias("o_orderkey")).distinct()
                .withColumn("returned", F.lit(True)))
    tier = F.when(F.col("c_acctbal") < 3000, F.lit("high_risk")).otherwise(F.lit("watch"))
    key = F.col("o_orderkey").cast("string")
    units = orders.join(cust, "o_custkey", "inner").join(returned, "o_orderkey", "left").select(
        "o_orderkey", key.alias("experiment_id"),
        F.col("o_custkey").cast("string").alias("account_id"), key.alias("sub_id"),
        tier.alias("risk_tier_at_assignment"),
        F.col("o_orderdate").cast("date").alias("assigned_date"),
        money("o_totalprice").alias("pre_experiment_mrr"),
        F.when(F.col("returned"), F.lit("churned")).otherwise(F.lit("renewed")).alias("outcome"))
    return assign_variant(units, "o_orderkey", EXPERIMENT_SALT).select(
        "experiment_id", "account_id", "sub_id", "risk_tier_at_assignment", "variant",
        "treatment_type", "assigned_date", "pre_experiment_mrr", "outcome",
        renewal_mrr("outcome", "pre_experiment_mrr").alias("renewal_mrr"))


def account_activity(spark: SparkSession, sf_dir: str,
                     since: dt.date = ACTIVITY_SINCE) -> DataFrame:
    """Per account (events.user_id): usage is the share of views, clicks and
    purchases among its events (whole percents, so 0 to 100 by definition),
    logins are views and clicks since `since`, support tickets errors since it."""
    return _activity(spark, sf_dir, since).drop("days_idle")


def _activity(spark: SparkSession, sf_dir: str, since: dt.date = ACTIVITY_SINCE) -> DataFrame:
    """account_activity plus days_idle: days from the account's last event to the
    end of the event history."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    etype, recent = F.col("event_type"), F.col("ts").cast("date") >= F.lit(since)
    per_user = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"),
        count_where(etype.isin("view", "click", "purchase")).alias("engaged"),
        count_where(etype.isin("view", "click") & recent).alias("logins"),
        count_where((etype == "error") & recent).alias("tickets"),
        F.max("ts").cast("date").alias("last_seen"))
    return per_user.select(
        F.col("user_id").cast("string").alias("account_id"),
        F.expr("CAST(100 * engaged DIV events AS INT)").alias("usage_score"),
        F.col("logins").cast("int").alias("login_frequency_30d"),
        F.col("tickets").cast("int").alias("support_tickets_30d"),
        F.date_diff(F.lit(ACTIVITY_UNTIL), "last_seen").alias("days_idle"))


def _won(spark: SparkSession, sf_dir: str, *said: str) -> DataFrame:
    """The won opportunities with what their line items say of a cancellation, and
    further columns of the roll-up."""
    return opportunities(spark, sf_dir, [WON_STAGE], with_segment=False, keep=["cancelled_on", *said])


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BR1 + BR2 over the won opportunities; an order with a returned line ends
    a year after the last one was shipped."""
    return derive_subscriptions(_won(spark, sf_dir), AS_OF, "cancelled_on")


def lifecycle_revenue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BR3 over the subscriptions, in one pass: the accepted lines are the
    expansion, a twelfth of their amount a year after the last was shipped."""
    said = ["expanded_on", "accepted_amount"]
    subs = derive_subscriptions(_won(spark, sf_dir, *said), AS_OF, "cancelled_on", keep=said)
    monthly = F.round(F.col("accepted_amount") / F.lit(12), 2)
    return derive_revenue_events(subs, AS_OF, "expanded_on", monthly)


def snapshot_offset():
    """Days before as-of of an active subscription's snapshot: 30, plus the days
    its account has been idle; 90 for an account without activity."""
    return F.coalesce(F.lit(30) + F.col("days_idle"), F.lit(90))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BR6 over the subscriptions and their accounts' activity."""
    idle = _activity(spark, sf_dir).select("account_id", "days_idle")
    return health_snapshots(subscriptions(spark, sf_dir).join(idle, "account_id", "left"), AS_OF,
                            snapshot_offset())


def health(spark: SparkSession, sf_dir: str, subs: DataFrame | None = None) -> DataFrame:
    """customer_health_scores: one snapshot per subscription (over `subs` when the
    caller already holds the subscriptions plan)."""
    subs = subs if subs is not None else subscriptions(spark, sf_dir)
    return customer_health_scores(subs, _activity(spark, sf_dir), AS_OF, snapshot_offset())


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per customer: industry from the nation, region from the
    region table (both tiny dimensions), arr from the balance."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                                  "r_name")
    signup = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("c_custkey") % 881).cast("int"))
    return (cust.join(nation, "c_nationkey", "left").join(region, "n_regionkey", "left")
            .select(F.col("c_custkey").cast("string").alias("account_id"),
                    F.col("c_name").alias("company_name"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("n_name").alias("industry"),
                    F.col("r_name").alias("region"),
                    money("c_acctbal").alias("arr"),
                    signup.alias("signup_date")))


def sales_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales rep per supplier: region through the nation, quota from the
    balance (floored), hire date spread over four years by key."""
    supp = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                                  "r_name")
    hired = F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("s_suppkey") % 1462).cast("int"))
    return (supp.join(nation, "s_nationkey", "left").join(region, "n_regionkey", "left")
            .select(F.col("s_suppkey").cast("string").alias("rep_id"),
                    F.col("s_name").alias("name"),
                    F.col("r_name").alias("region"),
                    F.floor("s_acctbal").cast("int").alias("quota_quarterly"),
                    hired.alias("hire_date")))


# raw table name -> adapter
RAW_ADAPTERS = {
    "sales_reps": sales_reps,
    "accounts": accounts,
    "leads": leads,
    "opportunities": opportunities,
    "subscriptions": subscriptions,
    "revenue_events": revenue_events,
    "customer_health_scores": health,
    "retention_experiments": retention_experiments,
}
