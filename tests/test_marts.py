import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from revops_spark.operators import marts as m

LEAD_SCHEMA = "lead_id string, segment string, lead_source string, status string, created_at date"
D = dt.date(2024, 2, 1)


def _leads(spark, rows):
    return spark.createDataFrame(rows, LEAD_SCHEMA)


def _by(rows, *keys):
    return {tuple(getattr(r, k) for k in keys): r for r in rows}


def test_funnel_is_cumulative(spark):
    statuses = ["New", "MQL", "SQL", "Opportunity", "Disqualified", None]
    rows = [(str(i), "SMB", "Paid Search", s, D) for i, s in enumerate(statuses)]
    out = m.fct_leads_funnel(_leads(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.total_leads, r.mql_count, r.sql_count, r.opportunity_count) == (6, 3, 2, 1)


def test_conversion_rates_groups_and_null_rates(spark):
    rows = [
        ("1", "SMB", None, "New", D), ("2", "SMB", "", "New", D), ("3", "SMB", "", "MQL", D),
        ("4", "Ent", "Webinar", "New", D), ("5", "Ent", "Webinar", "Disqualified", D),
        ("6", "Ent", "Ref", "MQL", D), ("7", "Ent", "Ref", "SQL", D), ("8", "Ent", "Ref", "Opportunity", D),
    ]
    out = _by(m.agg_conversion_rates(_leads(spark, rows)).collect(), "segment", "lead_source")
    assert set(out) == {("SMB", None), ("SMB", ""), ("Ent", "Webinar"), ("Ent", "Ref")}
    assert out[("SMB", None)].lead_to_mql_pct == 0.0
    assert out[("SMB", None)].mql_to_sql_pct is None          # zero MQLs -> NULL rate
    assert out[("SMB", "")].lead_to_mql_pct == 50.0
    ref = out[("Ent", "Ref")]
    assert (ref.lead_to_mql_pct, ref.mql_to_sql_pct, ref.sql_to_opp_pct) == (100.0, 66.67, 50.0)
    assert out[("Ent", "Webinar")].sql_to_opp_pct is None


def test_conversion_sums_to_funnel(spark):
    from conftest import SF_SMALL
    from revops_spark.sources import testdata as td
    leads = td.leads(spark, SF_SMALL)
    funnel = {r.segment: r for r in m.fct_leads_funnel(leads).collect()}
    conv = m.agg_conversion_rates(leads).groupBy("segment").agg(
        *[F.sum(c).alias(c) for c in ["total_leads", "mql_count", "sql_count", "opportunity_count"]])
    for r in conv.collect():
        f = funnel[r.segment]
        assert (r.total_leads, r.mql_count, r.sql_count, r.opportunity_count) == \
            (f.total_leads, f.mql_count, f.sql_count, f.opportunity_count)
        assert f.total_leads >= f.mql_count >= f.sql_count >= f.opportunity_count


def test_data_quality(spark):
    rows = [("1", None, "x", "New", D), ("2", "SMB", None, "New", D), ("3", "SMB", "", "New", None),
            ("4", "", "x", "New", D), ("5", "SMB", "x", "New", D), ("6", "SMB", "x", "New", D)]
    r = m.audit_data_quality_summary(_leads(spark, rows)).first()
    assert (r.total_leads, r.missing_lead_source_count, r.missing_segment_count,
            r.missing_created_at_count, r.total_issues) == (6, 2, 2, 1, 5)
    assert r.issue_rate_pct == 27.78 and r.data_quality_score_pct == 72.22
    assert abs(r.issue_rate_pct + r.data_quality_score_pct - 100) < 0.011


def test_data_quality_empty_table(spark):
    r = m.audit_data_quality_summary(_leads(spark, [])).first()
    assert r.total_leads == 0 and r.total_issues == 0
    assert r.issue_rate_pct is None and r.data_quality_score_pct is None


def test_kpi_scorecard_and_funnel_long(spark):
    rows = [("1", "SMB", "", "Opportunity", D), ("2", "SMB", "x", "SQL", D), ("3", "SMB", "x", "New", D)]
    k = m.kpi_scorecard(_leads(spark, rows)).first()
    assert (k.total_leads, k.opportunity_count, k.missing_lead_source_count) == (3, 1, 1)
    assert k.data_quality_score == 88.89
    long = sorted((r.stage_order, r.stage, r.n) for r in m.funnel_long(_leads(spark, rows)).collect())
    assert long == [(1, "Lead", 3), (2, "MQL", 2), (3, "SQL", 2), (4, "Opportunity", 1)]


OPP_SCHEMA = ("opp_id string, lead_id string, account_id string, rep_id string, segment string, "
              "lead_source string, plan string, stage string, amount decimal(18,2), "
              "created_date date, close_date date")


def _opp(i, seg, src, stage, created, closed):
    return (str(i), str(i), "a", "r", seg, src, "p", stage, Decimal("10.00"), created, closed)


def test_sales_cycle(spark):
    d0 = dt.date(2024, 1, 1)
    rows = [_opp(1, "SMB", "x", "Closed Won", d0, dt.date(2024, 1, 11)),
            _opp(2, "SMB", "x", "Closed Lost", d0, dt.date(2024, 1, 16)),
            _opp(3, "SMB", "x", "Closed Won", d0, d0),
            _opp(4, "SMB", "x", "Proposal", d0, dt.date(2025, 1, 1)),
            _opp(5, "Ent", "x", "Closed Won", d0, dt.date(2024, 1, 2)),
            _opp(6, "Ent", "x", "Closed Won", d0, dt.date(2024, 1, 3))]
    out = _by(m.agg_sales_cycle(spark.createDataFrame(rows, OPP_SCHEMA)).collect(), "segment")
    smb = out[("SMB",)]
    assert (smb.total_closed_deals, smb.avg_sales_cycle_days, smb.min_sales_cycle_days,
            smb.max_sales_cycle_days) == (3, 8.3, 0, 15)
    assert out[("Ent",)].avg_sales_cycle_days == 1.5


def test_win_rate(spark):
    d0 = dt.date(2024, 1, 1)
    rows = [_opp(1, "SMB", "x", "Closed Won", d0, d0), _opp(2, "SMB", "x", "Closed Lost", d0, d0),
            _opp(3, "SMB", "x", "Closed Lost", d0, d0), _opp(4, "SMB", "x", "Negotiation", d0, d0),
            _opp(5, "SMB", None, "Closed Lost", d0, d0)]
    out = _by(m.win_rate(spark.createDataFrame(rows, OPP_SCHEMA)).collect(), "segment", "lead_source")
    assert (out[("SMB", "x")].won_deals, out[("SMB", "x")].closed_deals,
            out[("SMB", "x")].win_rate_pct) == (1, 3, 33.33)
    assert out[("SMB", None)].win_rate_pct == 0.0


EV_SCHEMA = "event_id string, account_id string, sub_id string, event_type string, amount decimal(18,2), event_date date"


def test_mrr_waterfall_edges(spark):
    rows = [
        ("1", "a", "s", "new", Decimal("100.00"), dt.date(2024, 1, 5)),
        ("2", "a", "s", "expansion", Decimal("20.50"), dt.date(2024, 1, 20)),
        ("3", "a", "s", "churn", Decimal("-30.00"), dt.date(2024, 1, 31)),
        ("4", "a", "s", "refund", Decimal("999.00"), dt.date(2024, 2, 3)),     # unknown type only
        ("5", "a", "s", "new", None, dt.date(2024, 3, 3)),                     # only a NULL amount
        ("6", "a", "s", "new", Decimal("7.00"), None),                         # NULL month
        ("7", "a", "s", "churn", Decimal("-5.00"), dt.date(2024, 4, 1)),
        ("8", "a", "s", "new", None, dt.date(2024, 4, 2)),
    ]
    out = m.fct_mrr_waterfall(spark.createDataFrame(rows, EV_SCHEMA)).collect()
    months = [r.event_month for r in out]
    assert months == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1),
                      dt.date(2024, 4, 1), None]                      # sorted, NULL last
    jan, feb, mar, apr, nul = out
    assert (jan.new_mrr, jan.expansion_mrr, jan.churned_mrr, jan.net_mrr_change) == \
        (Decimal("100.00"), Decimal("20.50"), Decimal("-30.00"), Decimal("90.50"))
    assert (feb.new_mrr, feb.expansion_mrr, feb.churned_mrr, feb.net_mrr_change) == (0, 0, 0, 0)
    assert mar.new_mrr is None and mar.net_mrr_change is None
    assert (apr.new_mrr, apr.churned_mrr, apr.net_mrr_change) == (0, Decimal("-5.00"), Decimal("-5.00"))
    assert nul.new_mrr == Decimal("7.00")


def test_waterfall_net_equals_known_types(spark):
    from conftest import SF_SMALL
    from revops_spark.sources import testdata as td
    from revops_spark.operators.staging import stg_revenue_events
    ev = stg_revenue_events(td.revenue_events(spark, SF_SMALL))
    net = m.fct_mrr_waterfall(ev).agg(F.sum("net_mrr_change")).first()[0]
    known = ev.filter(F.col("event_type").isin("new", "expansion", "churn")).agg(F.sum("amount")).first()[0]
    assert net == known


def test_weighted_lead_marts_equal_row_level(spark):
    """Marts over pre-aggregated tallies (weight="n") equal the row-level marts."""
    from conftest import SF_SMALL
    from revops_spark.sources import testdata as td
    rows = td.leads(spark, SF_SMALL)
    tallies = m.lead_tallies(rows)
    for mart in (m.fct_leads_funnel, m.agg_conversion_rates, m.audit_data_quality_summary,
                 m.kpi_scorecard, m.funnel_long):
        a = sorted(map(tuple, mart(rows).collect()), key=repr)
        b = sorted(map(tuple, mart(tallies, weight="n").collect()), key=repr)
        assert a == b, mart.__name__


def test_weighted_empty_input_counts_zero(spark):
    empty = spark.createDataFrame([], LEAD_SCHEMA + ", n long")
    r = m.audit_data_quality_summary(empty, weight="n").first()
    assert r.total_leads == 0 and r.missing_segment_count == 0 and r.issue_rate_pct is None
    k = m.kpi_scorecard(empty, weight="n").first()
    assert (k.total_leads, k.opportunity_count) == (0, 0)


def test_audit_with_no_checks_and_custom_checks(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "")], "id int, v string")
    none = m.audit(df, {}).first()
    assert none.total_rows == 3 and none.total_issues == 0 and none.issue_rate_pct is None
    r = m.audit(df, {"blank_v": F.col("v").isNull() | (F.col("v") == "")}).first()
    assert (r.total_rows, r.blank_v, r.issue_rate_pct, r.data_quality_score_pct) == (3, 2, 66.67, 33.33)
