import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from revops_spark.operators import experiments as ex
from revops_spark.operators import lifecycle as lc

AS_OF = dt.date(2026, 6, 30)
OPP_SCHEMA = ("opp_id string, lead_id string, account_id string, rep_id string, segment string, "
              "lead_source string, plan string, stage string, amount decimal(18,2), "
              "created_date date, close_date date, end_candidate date")


def test_health_score_and_tier_edges(spark):
    rows = [(60, 25, 12), (60, 20, 0), (0, 0, 0), (100, 20, 0), (59, 10, 10), (60, 10, 10),
            (99, 10, 10), (100, 10, 10)]
    df = spark.createDataFrame(rows, "u int, l int, t int")
    out = df.select(lc.health_score("u", "l", "t").alias("s")).withColumn("tier", lc.risk_tier("s")).collect()
    ref = [round(u * 0.5 + min(l, 20) / 20 * 30 + max(0, 10 - t) / 10 * 20, 1) for u, l, t in rows]
    assert [float(r.s) for r in out] == ref
    assert [float(r.s) for r in out][4:] == [44.5, 45.0, 64.5, 65.0]
    assert [r.tier for r in out][4:] == ["high_risk", "watch", "watch", "healthy"]


def test_health_score_of_unknown_inputs_is_unknown(spark):
    rows = [(50, None, 2), (50, 10, None), (None, 10, 2), (50, 10, 2)]
    df = spark.createDataFrame(rows, "u int, l int, t int")
    out = df.select(lc.health_score("u", "l", "t").alias("s")).withColumn("tier", lc.risk_tier("s")).collect()
    assert [r.s for r in out] == [None, None, None, Decimal("56.0")]
    assert [r.tier for r in out] == [None, None, None, "watch"]


def test_health_score_counts_fractional_usage_in_full(spark):
    df = spark.createDataFrame([(45.9, 0, 10), (45.0, 0, 10)], "u double, l int, t int")
    assert [float(r.s) for r in df.select(lc.health_score("u", "l", "t").alias("s")).collect()] == [23.0, 22.5]


def test_expansions_on_one_day_have_their_own_ids(spark):
    exps = spark.createDataFrame([("s2", dt.date(2025, 5, 1), Decimal("5.00")),
                                  ("s2", dt.date(2025, 5, 1), Decimal("7.00"))],
                                 "sub_id string, expansion_date date, amount decimal(18,2)")
    ids = [r.event_id for r in lc.derive_revenue_events(_subs(spark), AS_OF, expansions=exps).collect()]
    assert len(ids) == len(set(ids)) == 6
    assert {"s2-expansion-20250501", "s2-expansion-20250501-2"} <= set(ids)


def test_subscription_without_activity_keeps_its_snapshot(spark):
    activity = spark.createDataFrame([("a2", 95, 25, 0)], "account_id string, usage_score int, "
                                     "login_frequency_30d int, support_tickets_30d int")
    rows = {r.sub_id: r for r in lc.customer_health_scores(_subs(spark), activity, AS_OF).collect()}
    assert set(rows) == {"s1", "s2", "s3"}
    assert (rows["s1"].usage_score, rows["s1"].health_score, rows["s1"].risk_tier) == (None, None, None)
    assert rows["s3"].risk_tier == "healthy"


def test_missing_subscription_fails_unless_allowed(spark):
    import pytest
    from pyspark.errors import PySparkException
    health = spark.createDataFrame([("a1", "s1", "watch", dt.date(2025, 1, 1)),
                                    ("a9", "gone", "watch", dt.date(2025, 1, 1))],
                                   "account_id string, sub_id string, risk_tier string, snapshot_date date")
    with pytest.raises(PySparkException, match="no subscription gone"):
        ex.eligible_for_experiment(health, _subs(spark)).collect()
    assert [r.sub_id for r in ex.eligible_for_experiment(health, _subs(spark), strict=False).collect()] == ["s1"]


def test_subscriptions_end_before_on_after_as_of(spark):
    d = dt.date(2025, 1, 1)
    rows = [
        ("1", "l", "a1", "r", "SMB", "x", "SOC2 Starter", "Closed Won", Decimal("1200.06"), d, d, dt.date(2026, 6, 29)),
        ("2", "l", "a2", "r", "SMB", "x", "SOC2 Starter", "Closed Won", Decimal("1200.00"), d, d, AS_OF),
        ("3", "l", "a3", "r", "SMB", "x", "SOC2 Starter", "Closed Won", Decimal("1200.00"), d, d, dt.date(2026, 7, 1)),
        ("4", "l", "a4", "r", "SMB", "x", "SOC2 Starter", "Closed Won", Decimal("1200.00"), d, d, None),
        ("5", "l", "a5", "r", "SMB", "x", "SOC2 Starter", "Closed Lost", Decimal("1200.00"), d, d, None),
    ]
    opps = spark.createDataFrame(rows, OPP_SCHEMA)
    subs = {r.sub_id: r for r in lc.derive_subscriptions(opps, AS_OF, "end_candidate").collect()}
    assert set(subs) == {"1", "2", "3", "4"}
    assert (subs["1"].status, subs["1"].end_date) == ("churned", dt.date(2026, 6, 29))
    assert (subs["2"].status, subs["2"].end_date) == ("active", None)
    assert (subs["3"].status, subs["3"].end_date) == ("active", None)
    assert subs["1"].mrr == Decimal("100.01")      # 1200.06 / 12 = 100.005 -> HALF_UP
    assert subs["4"].start_date == d


SUB_SCHEMA = ("sub_id string, account_id string, opp_id string, plan string, mrr decimal(18,2), "
              "start_date date, end_date date, status string")


def _subs(spark):
    return spark.createDataFrame([
        ("s1", "a1", "o1", "p", Decimal("100.00"), dt.date(2025, 1, 1), dt.date(2025, 6, 1), "churned"),
        ("s2", "a1", "o2", "p", Decimal("50.00"), dt.date(2025, 2, 1), None, "active"),
        ("s3", "a2", "o3", "p", Decimal("10.00"), dt.date(2026, 6, 1), None, "active"),
    ], SUB_SCHEMA)


def test_revenue_events(spark):
    subs = _subs(spark)
    exps = spark.createDataFrame([
        ("s2", dt.date(2025, 5, 1), Decimal("5.00")),     # active, before as-of -> kept
        ("s1", dt.date(2025, 3, 1), Decimal("9.00")),     # churned sub -> dropped
        ("s3", dt.date(2026, 8, 1), Decimal("1.00")),     # after as-of -> dropped
    ], "sub_id string, expansion_date date, amount decimal(18,2)")
    ev = sorted((r.sub_id, r.type, r.amount, r.event_date)
                for r in lc.derive_revenue_events(subs, AS_OF, expansions=exps).collect())
    # the same expansions as columns of the subscription rows: one pass, same events
    as_cols = subs.join(exps.withColumnRenamed("amount", "x_amount"), "sub_id", "left")
    one_pass = sorted((r.sub_id, r.type, r.amount, r.event_date) for r in lc.derive_revenue_events(
        as_cols, AS_OF, "expansion_date", "x_amount").collect())
    assert one_pass == ev
    assert ev == [
        ("s1", "churn", Decimal("-100.00"), dt.date(2025, 6, 1)),
        ("s1", "new", Decimal("100.00"), dt.date(2025, 1, 1)),
        ("s2", "expansion", Decimal("5.00"), dt.date(2025, 5, 1)),
        ("s2", "new", Decimal("50.00"), dt.date(2025, 2, 1)),
        ("s3", "new", Decimal("10.00"), dt.date(2026, 6, 1)),
    ]


def test_snapshots_health_and_eligibility(spark):
    subs = _subs(spark)
    snaps = {r.sub_id: r.snapshot_date for r in lc.health_snapshots(subs, AS_OF, 90).collect()}
    assert snaps["s1"] == dt.date(2025, 3, 3)             # end - 90 d
    assert snaps["s2"] == dt.date(2026, 4, 1)             # as-of - 90 d
    assert snaps["s3"] == dt.date(2026, 6, 16)            # before start -> start + 15 d
    activity = spark.createDataFrame([("a1", 30, 2, 6), ("a2", 95, 25, 0)],
                                     "account_id string, usage_score int, login_frequency_30d int, support_tickets_30d int")
    health = lc.customer_health_scores(subs, activity, AS_OF, 90)
    h = {r.sub_id: r for r in health.collect()}
    assert h["s1"].risk_tier == "high_risk" and float(h["s1"].health_score) == 26.0
    assert h["s3"].risk_tier == "healthy"
    assert h["s2"].days_to_renewal == 365 - (dt.date(2026, 4, 1) - dt.date(2025, 2, 1)).days % 365
    eligible = ex.eligible_for_experiment(health, subs)
    got = {r.sub_id: r for r in eligible.collect()}
    assert set(got) == {"s1", "s2"}
    assert got["s1"].assigned_date == dt.date(2025, 3, 8)
    assert got["s2"].pre_experiment_mrr == Decimal("50.00")
    exps = ex.build_experiments(eligible, "sub_id", "exp1")
    assert exps.columns[:3] == ["experiment_id", "account_id", "sub_id"]
    assert exps.filter(F.col("variant").isNull()).count() == 0
