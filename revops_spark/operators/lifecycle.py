"""Customer-lifecycle derivations (BR1-BR6).

The reference draws these with a random generator; its deterministic rules are
kept here as DataFrame transforms and the random draws become inputs (columns
or parameters).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ColumnOrName, col, days_between

WON_STAGE = "Closed Won"
DateLike = str | dt.date | Column


def _date(d: DateLike) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def subscription_status(end: ColumnOrName, as_of: DateLike) -> tuple[Column, Column]:
    """BR2: (status, end_date). Churned only when the end falls before as-of;
    otherwise active with no end date."""
    end = col(end)
    churned = end.isNotNull() & (end < _date(as_of))
    return (F.when(churned, F.lit("churned")).otherwise(F.lit("active")),
            F.when(churned, end))


def derive_subscriptions(opps: DataFrame, as_of: DateLike,
                         candidate_end: ColumnOrName | None = None,
                         keep: list[str] | None = None) -> DataFrame:
    """BR1 + BR2: one subscription per won opportunity.

    start = close_date; mrr = round(amount / 12, 2); `candidate_end` (a Column
    over the opportunity rows, NULL for no churn) is the end date that BR2 turns
    into status and end_date. `keep` names further columns to carry along.
    """
    end = col(candidate_end) if candidate_end is not None else F.lit(None).cast("date")
    won = opps.filter(F.col("stage") == WON_STAGE).withColumn("_end", end.cast("date"))
    status, end_date = subscription_status("_end", as_of)
    return won.select(
        F.col("opp_id").alias("sub_id"), "account_id", "opp_id", "plan",
        F.round(F.col("amount") / F.lit(12), 2).cast("decimal(18,2)").alias("mrr"),
        F.col("close_date").alias("start_date"),
        end_date.alias("end_date"),
        status.alias("status"),
        *(keep or []),
    )


def derive_revenue_events(subs: DataFrame, as_of: DateLike,
                          expansion_date: ColumnOrName | None = None,
                          expansion_amount: ColumnOrName | None = None,
                          expansions: DataFrame | None = None) -> DataFrame:
    """BR3: the revenue events of each subscription.

    `new` (+mrr) at the start; `churn` (-mrr) at the end of a churned one; an
    `expansion` for an active subscription whose expansion falls before as-of.

    As in the reference, a subscription expands at most once, so its expansion
    can be two columns of the subscription row (`expansion_date`,
    `expansion_amount`, NULL for none): then every event comes from one pass
    over the subscriptions (an array of candidate events, NULLs filtered,
    exploded) with no join and no second scan. A separate `expansions` table
    (sub_id, expansion_date, amount; any number per subscription) is joined to
    the active subscriptions instead; where it has several for one day, the
    later ones (by amount) get a running number in their event_id.
    """
    churned, active = F.col("status") == "churned", F.col("status") == "active"
    events = [
        F.struct(F.lit("new").alias("type"), F.col("mrr").alias("amount"),
                 F.col("start_date").alias("event_date")),
        F.when(churned, F.struct(F.lit("churn").alias("type"), (-F.col("mrr")).alias("amount"),
                                 F.col("end_date").alias("event_date"))),
    ]
    if expansion_date is not None:
        grows = active & (col(expansion_date) < _date(as_of))
        events.append(F.when(grows, F.struct(
            F.lit("expansion").alias("type"),
            col(expansion_amount).cast("decimal(18,2)").alias("amount"),
            col(expansion_date).cast("date").alias("event_date"))))
    out = subs.select("account_id", "sub_id",
                      F.inline(F.filter(F.array(*events), lambda e: e.isNotNull())))
    if expansions is not None:
        same_day = Window.partitionBy("sub_id", "expansion_date").orderBy("amount")
        grown = (expansions.filter(F.col("expansion_date") < _date(as_of))
                 .withColumn("nth", F.row_number().over(same_day))
                 .join(subs.filter(active).select("sub_id", "account_id"), "sub_id", "inner")
                 .select("account_id", "sub_id", F.lit("expansion").alias("type"),
                         F.col("amount").cast("decimal(18,2)").alias("amount"),
                         F.col("expansion_date").alias("event_date"),
                         F.when(F.col("nth") > 1, F.col("nth").cast("string")).alias("nth")))
        out = out.withColumn("nth", F.lit(None).cast("string")).unionByName(grown)
    # concat_ws leaves NULL parts out
    number = [F.col("nth")] if expansions is not None else []
    event_id = F.concat_ws("-", "sub_id", "type", F.date_format("event_date", "yyyyMMdd"), *number)
    return out.select(event_id.alias("event_id"), "account_id", "sub_id", "type",
                      "amount", "event_date")


def health_score(usage: ColumnOrName, logins: ColumnOrName, tickets: ColumnOrName) -> Column:
    """BR4: round(0.5 usage + min(logins, 20) / 20 * 30 + max(0, 10 - tickets) / 10 * 20, 1).

    The value is (usage + 3 min(logins, 20) + 4 max(0, 10 - tickets)) / 2, computed
    in decimals: exact for integers, and fractional inputs count in full (up to
    four decimals) before the one rounding. NULL if any input is NULL (`least`
    and `greatest` alone would skip it).
    """
    u, n, t = (col(c).cast("decimal(14,4)") for c in (usage, logins, tickets))
    twice = (u + F.lit(3) * F.least(n, F.lit(20).cast("decimal(14,4)"))
             + F.lit(4) * F.greatest(F.lit(0).cast("decimal(14,4)"), F.lit(10) - t))
    known = u.isNotNull() & n.isNotNull() & t.isNotNull()
    return F.when(known, F.round(twice / F.lit(2), 1)).cast("decimal(12,1)")


def risk_tier(score: ColumnOrName) -> Column:
    """BR5: < 45 high_risk, < 65 watch, otherwise healthy."""
    s = col(score)
    return (F.when(s < 45, F.lit("high_risk"))
             .when(s < 65, F.lit("watch"))
             .when(s.isNotNull(), F.lit("healthy")))


def score_accounts(activity: DataFrame) -> DataFrame:
    """BR4 + BR5 over (usage_score, login_frequency_30d, support_tickets_30d)."""
    score = health_score("usage_score", "login_frequency_30d", "support_tickets_30d")
    return (activity.withColumn("health_score", score)
            .withColumn("risk_tier", risk_tier("health_score")))


def health_snapshot_date(status: ColumnOrName, start: ColumnOrName, end: ColumnOrName,
                         as_of: DateLike, offset_days: int | ColumnOrName) -> Column:
    """BR6: churned -> end - 90 d; active -> as-of - offset; never before start
    (then start + 15 d)."""
    offset = F.lit(offset_days) if isinstance(offset_days, int) else col(offset_days)
    snap = F.when(col(status) == "churned", F.date_sub(col(end), 90)) \
            .otherwise(F.date_sub(_date(as_of), offset.cast("int")))
    return F.when(snap < col(start), F.date_add(col(start), 15)).otherwise(snap)


def health_snapshots(subs: DataFrame, as_of: DateLike,
                     offset_days: int | ColumnOrName = 90) -> DataFrame:
    """BR6 per subscription: sub_id, account_id, start_date, status, end_date, snapshot_date."""
    snap = health_snapshot_date("status", "start_date", "end_date", as_of, offset_days)
    return subs.select("sub_id", "account_id", "start_date", "status", "end_date",
                       snap.alias("snapshot_date"))


def customer_health_scores(subs: DataFrame, activity: DataFrame, as_of: DateLike,
                           offset_days: int | ColumnOrName = 90) -> DataFrame:
    """One health snapshot per subscription, with or without account activity.

    activity: account_id, usage_score, login_frequency_30d, support_tickets_30d;
    `offset_days` may also use its further columns. Without activity the measures,
    the score and the tier are NULL: nothing is known, which isn't a score of 0.
    days_to_renewal counts to the next yearly (365-day) anniversary of the start.
    An account with many subscriptions is a hot key of this join; AQE splits it.
    """
    snap = health_snapshot_date("status", "start_date", "end_date", as_of, offset_days)
    joined = subs.join(score_accounts(activity), "account_id", "left").withColumn(
        "snapshot_date", snap)
    tenure = days_between("start_date", "snapshot_date")
    return joined.select(
        F.col("sub_id").alias("health_id"), "account_id", "sub_id", "snapshot_date",
        F.col("usage_score").cast("int").alias("usage_score"),
        F.col("login_frequency_30d").cast("int").alias("login_frequency_30d"),
        F.col("support_tickets_30d").cast("int").alias("support_tickets_30d"),
        (F.lit(365) - F.pmod(tenure, F.lit(365))).cast("int").alias("days_to_renewal"),
        "health_score", "risk_tier",
    )
