"""DuckDB oracle: independent SQL for every registered query.

Nothing here comes from the package under test: constants are literals, and the
metrics are stated from their definitions, where possible by another route than
the Spark code takes: counts by FILTER, quality issues counted per lead, the z
statistic from the 2 x 2 table's chi-square, Wilson bounds as the roots of their
quadratic, Cohen's h by atan2, p-values and the power function by Simpson
integration of the normal density, sample sizes by bisection. Output types
follow the registered queries: dates as ISO text, money as double, statistics
rounded to 10 decimals (sample sizes to 4).
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"
DIGITS = 10
SAMPLE_DIGITS = 4
Z_975 = "1.959963984540054"      # normal quantiles at 0.975 and 0.8
POWER = "0.8"


def half_up(num: str, den: str, scale: int, factor: int = 1) -> str:
    """round(num * factor / nullif(den, 0), scale), HALF_UP on the exact rational."""
    m = 10 ** scale * factor
    n, d = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    return (f"(CAST(CASE WHEN {d} = 0 THEN NULL ELSE "
            f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
            f"((2 * {m} * abs({n}) + abs({d})) // (2 * abs({d}))) END AS DOUBLE) "
            f"/ CAST({10 ** scale} AS DOUBLE))")


def pct(num: str, den: str) -> str:
    return half_up(num, den, 2, 100)


def txt(d: str) -> str:
    return f"CAST({d} AS VARCHAR)"


# --- adapters --------------------------------------------------------------------
LEADS = """
leads AS (
  SELECT CAST(e.event_id AS VARCHAR) AS lead_id,
         c.c_mktsegment AS segment,
         (['Paid Search', 'Organic Search', 'Content Download', 'Partner Referral',
           'Compliance Webinar', 'Outbound Prospecting', 'G2/Capterra Review',
           'Security Conference', ''])[TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 9 + 1]
           AS lead_source,
         MAP {'view': 'New', 'click': 'MQL', 'signup': 'SQL', 'purchase': 'Opportunity',
              'error': 'Disqualified'}[e.event_type] AS status,
         CAST(e.ts AS DATE) AS created_at
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
)"""

OPPS = """
last_ship AS (
  SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last_ship FROM lineitem GROUP BY l_orderkey
),
opps AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS opp_id,
         CAST(o.o_orderkey AS VARCHAR) AS lead_id,
         CAST(o.o_custkey AS VARCHAR) AS account_id,
         CAST(o.o_custkey AS VARCHAR) AS rep_id,
         c.c_mktsegment AS segment,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o.o_orderpriority END AS lead_source,
         'SOC2 Starter' AS plan,
         CASE o.o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'O' THEN 'Closed Lost'
              WHEN 'P' THEN 'Negotiation' END AS stage,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount,
         CAST(o.o_orderdate AS DATE) AS created_date,
         CASE WHEN ls.last_ship IS NULL OR ls.last_ship < CAST(o.o_orderdate AS DATE)
              THEN CAST(o.o_orderdate AS DATE) ELSE ls.last_ship END AS close_date
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN last_ship ls ON o.o_orderkey = ls.l_orderkey
)"""

REVENUE = """
revenue_events AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
         CAST(l_suppkey AS VARCHAR) AS account_id,
         CAST(l_orderkey AS VARCHAR) AS sub_id,
         CASE l_returnflag WHEN 'N' THEN 'new' WHEN 'A' THEN 'expansion' WHEN 'R' THEN 'churn' END
           AS event_type,
         CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
         CAST(l_shipdate AS DATE) AS event_date
  FROM lineitem
)"""

_treatments = "['csm_strategic_call', 'audit_prep_discount_10pct', 'free_extra_framework_addon']"


def _assign(key: str) -> str:
    """variant / treatment_type columns from md5('exp1:' || key)."""
    h = f"md5('exp1:' || {key})"
    ctl = f"substr({h}, 1, 8) < '80000000'"
    pick = f"{_treatments}[CAST(('0x' || substr({h}, 9, 8)) AS BIGINT) % 3 + 1]"
    return (f"CASE WHEN {ctl} THEN 'control' ELSE 'treatment' END AS variant, "
            f"CASE WHEN {ctl} THEN 'none' ELSE {pick} END AS treatment_type")


EXPERIMENTS = f"""
exp_units AS (
  SELECT o.o_orderkey, c.c_acctbal, o.o_custkey, o.o_totalprice, o.o_orderdate
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_acctbal < 7000
),
exp_base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS experiment_id,
         CAST(o_custkey AS VARCHAR) AS account_id,
         CAST(o_orderkey AS VARCHAR) AS sub_id,
         CASE WHEN c_acctbal < 3000 THEN 'high_risk' ELSE 'watch' END AS risk_tier_at_assignment,
         {_assign("CAST(o_orderkey AS VARCHAR)")},
         CAST(o_orderdate AS DATE) AS assigned_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS pre_experiment_mrr,
         CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
              THEN 'churned' ELSE 'renewed' END AS outcome
  FROM exp_units
),
experiments AS (
  SELECT *, CASE WHEN outcome = 'churned' THEN CAST(0 AS DECIMAL(18,2))
                 ELSE pre_experiment_mrr END AS renewal_mrr
  FROM exp_base
)"""

ACTIVITY = """
activity AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id,
         CAST(100 * count(*) FILTER (event_type NOT IN ('signup', 'error')) // count(*) AS INTEGER) AS usage_score,
         CAST(count(*) FILTER (event_type IN ('view', 'click') AND ts >= TIMESTAMP '2024-01-17')
              AS INTEGER) AS login_frequency_30d,
         CAST(count(*) FILTER (event_type = 'error' AND ts >= TIMESTAMP '2024-01-17')
              AS INTEGER) AS support_tickets_30d,
         date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-30') AS days_idle
  FROM events GROUP BY user_id
),
scored AS (
  SELECT *, (usage_score + 3 * least(login_frequency_30d, 20)
             + 4 * greatest(0, 10 - support_tickets_30d)) / 2.0 AS health_score
  FROM activity
),
scored_tier AS (
  SELECT *, CASE WHEN health_score >= 65 THEN 'healthy' WHEN health_score >= 45 THEN 'watch'
                 ELSE 'high_risk' END AS risk_tier
  FROM scored
)"""

# money kept in integer cents from here on: mrr = round(amount / 12, 2) HALF_UP;
# a returned or accepted line takes effect twelve months after its shipment
SUBS = OPPS + f""",
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS opp_id,
         CAST(CAST(max(l_shipdate) FILTER (l_returnflag = 'R') AS DATE) + INTERVAL 12 MONTH AS DATE)
           AS cand_end,
         CAST(CAST(max(l_shipdate) FILTER (l_returnflag = 'A') AS DATE) + INTERVAL 12 MONTH AS DATE)
           AS grown_on,
         CAST(sum(round(l_extendedprice * 100)) FILTER (l_returnflag = 'A') AS BIGINT) AS grown_cents
  FROM lineitem GROUP BY l_orderkey
),
subs AS (
  SELECT opp_id AS sub_id, account_id, opp_id, plan,
         (CAST(round(amount * 100) AS BIGINT) + 6) // 12 AS mrr_cents,
         close_date AS start_date,
         CASE WHEN cand_end < {AS_OF} THEN cand_end END AS end_date,
         CASE WHEN cand_end < {AS_OF} THEN 'churned' ELSE 'active' END AS status,
         grown_on, grown_cents
  FROM opps LEFT JOIN lines USING (opp_id) WHERE stage = 'Closed Won'
)"""

SNAPS = "," + ACTIVITY + f""",
snap0 AS (
  SELECT s.*, a.* EXCLUDE (account_id),
         coalesce(end_date - 90, {AS_OF} - CAST(coalesce(30 + days_idle, 90) AS INTEGER)) AS s0
  FROM subs s LEFT JOIN scored_tier a USING (account_id)
),
snaps AS (
  SELECT *, CASE WHEN s0 >= start_date THEN s0 ELSE start_date + 15 END AS snapshot_date
  FROM snap0
)"""

HEALTH = SUBS + SNAPS + """,
health AS (
  SELECT sub_id AS health_id, account_id, sub_id, snapshot_date,
         usage_score, login_frequency_30d, support_tickets_30d,
         CAST(365 - (date_diff('day', start_date, snapshot_date) % 365) AS INTEGER) AS days_to_renewal,
         health_score, risk_tier, mrr_cents
  FROM snaps
)"""

ACCOUNTS = """
accounts AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS account_id, c.c_name AS company_name,
         c.c_mktsegment AS segment, n.n_name AS industry, r.r_name AS region,
         CAST(c.c_acctbal AS DECIMAL(18,2)) AS arr,
         DATE '2024-01-01' + CAST(c.c_custkey % 881 AS INTEGER) AS signup_date
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

REPS = """
reps AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS rep_id, s.s_name AS rep_name, r.r_name AS region,
         CAST(floor(s.s_acctbal) AS INTEGER) AS quota_quarterly,
         DATE '2022-01-01' + CAST(s.s_suppkey % 1462 AS INTEGER) AS hire_date
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# --- marts -----------------------------------------------------------------------
_STAGE_COUNTS = """count(*) AS total_leads,
       count(*) FILTER (status IN ('MQL', 'SQL', 'Opportunity')) AS mql_count,
       count(*) FILTER (status IN ('SQL', 'Opportunity')) AS sql_count,
       count(*) FILTER (status = 'Opportunity') AS opportunity_count"""

LEADS_FUNNEL = _with(LEADS) + f"""
SELECT segment, {_STAGE_COUNTS} FROM leads GROUP BY segment"""

CONVERSION_RATES = _with(LEADS) + f"""
SELECT segment, lead_source, {_STAGE_COUNTS},
       {pct('mql_count', 'total_leads')} AS lead_to_mql_pct,
       {pct('sql_count', 'mql_count')} AS mql_to_sql_pct,
       {pct('opportunity_count', 'sql_count')} AS sql_to_opp_pct
FROM leads GROUP BY segment, lead_source"""

QUALIFIED_LEADS = _with(LEADS) + f"""
SELECT lead_id, segment, lead_source, status, {txt('created_at')} AS created_at
FROM leads WHERE status IN ('SQL', 'Opportunity')"""

# one row per lead and audited cell, so that issues and cells are plain counts
_CELLS = """
cells AS (
  SELECT lead_id, status, unnest([coalesce(lead_source, '') = '', coalesce(segment, '') = '',
                                  created_at IS NULL]) AS bad,
         unnest(['source', 'segment', 'date']) AS cell
  FROM leads
)"""

DATA_QUALITY = _with(LEADS, _CELLS) + f"""
SELECT count(DISTINCT lead_id) AS total_leads,
       count(*) FILTER (bad AND cell = 'source') AS missing_lead_source_count,
       count(*) FILTER (bad AND cell = 'segment') AS missing_segment_count,
       count(*) FILTER (bad AND cell = 'date') AS missing_created_at_count,
       count(*) FILTER (bad) AS total_issues,
       {pct('count(*) FILTER (bad)', 'count(*)')} AS issue_rate_pct,
       {pct('count(*) FILTER (NOT bad)', 'count(*)')} AS data_quality_score_pct
FROM cells"""

KPI_SCORECARD = _with(LEADS, _CELLS) + f"""
SELECT count(DISTINCT lead_id) AS total_leads,
       count(DISTINCT lead_id) FILTER (status = 'Opportunity') AS opportunity_count,
       {pct('count(*) FILTER (NOT bad)', 'count(*)')} AS data_quality_score,
       count(*) FILTER (bad AND cell = 'source') AS missing_lead_source_count
FROM cells"""

# a lead counts for its own stage and every stage before it
FUNNEL_LONG = _with(LEADS) + """
SELECT CAST(v.stage_order AS INTEGER) AS stage_order, v.stage,
       (SELECT count(*) FROM leads
        WHERE CASE status WHEN 'Opportunity' THEN 4 WHEN 'SQL' THEN 3 WHEN 'MQL' THEN 2 ELSE 1 END
              >= v.stage_order) AS n
FROM (VALUES (1, 'Lead'), (2, 'MQL'), (3, 'SQL'), (4, 'Opportunity')) v(stage_order, stage)"""

SALES_CYCLE = _with(OPPS, """
closed AS (
  SELECT segment, date_diff('day', created_date, close_date) AS d
  FROM opps WHERE stage IN ('Closed Won', 'Closed Lost')
)""") + f"""
SELECT segment, count(*) AS total_closed_deals,
       {half_up('sum(d)', 'count(d)', 1)} AS avg_sales_cycle_days,
       min(d) AS min_sales_cycle_days, max(d) AS max_sales_cycle_days
FROM closed GROUP BY segment"""

WIN_RATE = _with(OPPS) + f"""
SELECT segment, lead_source, count(*) FILTER (stage = 'Closed Won') AS won_deals,
       count(*) AS closed_deals,
       {pct("count(*) FILTER (stage = 'Closed Won')", 'count(*)')} AS win_rate_pct
FROM opps WHERE stage <> 'Negotiation' GROUP BY segment, lead_source"""

MRR_WATERFALL = _with(REVENUE) + """
SELECT strftime(event_date, '%Y-%m-01') AS event_month,
       coalesce(sum(amount) FILTER (event_type = 'new'), 0)::DOUBLE AS new_mrr,
       coalesce(sum(amount) FILTER (event_type = 'expansion'), 0)::DOUBLE AS expansion_mrr,
       coalesce(sum(amount) FILTER (event_type = 'churn'), 0)::DOUBLE AS churned_mrr,
       sum(amount)::DOUBLE AS net_mrr_change
FROM revenue_events GROUP BY event_month ORDER BY event_month"""

_AB_MART = """
ab_mart AS (
  SELECT variant, risk_tier_at_assignment, count(*) AS total_accounts,
         count(*) FILTER (outcome = 'churned') AS churned_count,
         sum(pre_experiment_mrr) AS total_pre_experiment_mrr,
         coalesce(sum(pre_experiment_mrr) FILTER (outcome <> 'churned'), 0) AS total_retained_mrr
  FROM experiments GROUP BY ALL
)"""

CHURN_AB_RESULTS = _with(EXPERIMENTS, _AB_MART) + f"""
SELECT variant, risk_tier_at_assignment, total_accounts, churned_count,
       total_accounts - churned_count AS renewed_count,
       {pct('churned_count', 'total_accounts')} AS churn_rate_pct,
       total_pre_experiment_mrr::DOUBLE AS total_pre_experiment_mrr,
       total_retained_mrr::DOUBLE AS total_retained_mrr
FROM ab_mart ORDER BY 2, 1"""

# churned a and kept b of the control arm, churned c and kept d of the treatment arm
_ARMS = """
table2x2 AS (
  SELECT coalesce(risk_tier_at_assignment, 'overall') AS stratum,
         GROUPING(risk_tier_at_assignment) = 1 AS is_overall,
         sum(churned_count) FILTER (variant = 'control') AS a,
         sum(total_accounts - churned_count) FILTER (variant = 'control') AS b,
         sum(churned_count) FILTER (variant = 'treatment') AS c,
         sum(total_accounts - churned_count) FILTER (variant = 'treatment') AS d
  FROM ab_mart GROUP BY ROLLUP (risk_tier_at_assignment)
),
arms AS (
  SELECT stratum, is_overall, a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c, d::DOUBLE AS d,
         a::BIGINT AS control_churned, (a + b)::BIGINT AS control_total,
         c::BIGINT AS treatment_churned, (c + d)::BIGINT AS treatment_total,
         a::DOUBLE / (a + b) AS p1, c::DOUBLE / (c + d) AS p2
  FROM table2x2
)"""


def _normal_mass(x: str) -> str:
    """Standard normal probability between 0 and x >= 0, by Simpson's rule."""
    steps = 4000
    weight = f"(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    return (f"(list_sum(list_transform(range(0, {steps + 1}), lambda i: {weight} "
            f"* exp(-0.5 * pow(i * ({x}) / {steps}.0, 2)))) * ({x}) / {steps}.0 / 3.0 / sqrt(2.0 * pi()))")


def _wilson(p: str, n: str, sign: str) -> str:
    """A root q of (p - q)^2 = z^2 q (1 - q) / n."""
    z2 = f"({Z_975} * {Z_975} / {n})"
    return (f"((2.0 * {p} + {z2}) {sign} sqrt(pow(2.0 * {p} + {z2}, 2) - 4.0 * (1.0 + {z2}) * {p} * {p}))"
            f" / (2.0 * (1.0 + {z2}))")


AB_SIGNIFICANCE = _with(EXPERIMENTS, _AB_MART, _ARMS, f"""
bounds AS (
  SELECT *, sign(p1 - p2) * sqrt((a + b + c + d) * pow(a * d - b * c, 2)
                                 / ((a + b) * (c + d) * (a + c) * (b + d))) AS z_stat,
         {_wilson('p1', '(a + b)', '-')} AS l1, {_wilson('p1', '(a + b)', '+')} AS u1,
         {_wilson('p2', '(c + d)', '-')} AS l2, {_wilson('p2', '(c + d)', '+')} AS u2
  FROM arms
),
tested AS (SELECT *, greatest(0.0, 1.0 - 2.0 * {_normal_mass('abs(z_stat)')}) AS p FROM bounds)""") + f"""
SELECT stratum, is_overall, control_churned, control_total, treatment_churned, treatment_total,
       round(p1, {DIGITS}) AS control_churn_rate, round(p2, {DIGITS}) AS treatment_churn_rate,
       round(p1 - p2, {DIGITS}) AS rate_difference, round(z_stat, {DIGITS}) AS z_stat,
       round(l1, {DIGITS}) AS control_ci_low, round(u1, {DIGITS}) AS control_ci_high,
       round(l2, {DIGITS}) AS treatment_ci_low, round(u2, {DIGITS}) AS treatment_ci_high,
       round(p1 - p2 - sqrt(pow(p1 - l1, 2) + pow(u2 - p2, 2)), {DIGITS}) AS diff_ci_low,
       round(p1 - p2 + sqrt(pow(u1 - p1, 2) + pow(p2 - l2, 2)), {DIGITS}) AS diff_ci_high,
       round(p, {DIGITS}) AS p_value, p < 0.05 AS significant
FROM tested"""

_SHIFT = "h * sqrt((low + high) / 4.0)"       # |h| sqrt(n / 2) at the interval's middle
_REACHED = (f"(0.5 - sign({Z_975} - {_SHIFT}) * {_normal_mass(f'abs({Z_975} - {_SHIFT})')}"
            f" + 0.5 - {_normal_mass(f'{Z_975} + {_SHIFT}')})")

# the n at which a two-sided test reaches the power, by halving an interval 70 times
AB_POWER = "WITH RECURSIVE " + ",".join([EXPERIMENTS, _AB_MART, _ARMS, f"""
effect AS (
  SELECT *, 2.0 * atan2(sqrt(p1), sqrt(1.0 - p1)) - 2.0 * atan2(sqrt(p2), sqrt(1.0 - p2)) AS cohens_h
  FROM arms
),
halved(stratum, is_overall, h, low, high, step) AS (
  SELECT stratum, is_overall, abs(cohens_h), 0.0::DOUBLE, 20.0 / pow(cohens_h, 2), 0
  FROM effect WHERE cohens_h <> 0
  UNION ALL
  SELECT stratum, is_overall, h, CASE WHEN {_REACHED} < {POWER} THEN (low + high) / 2.0 ELSE low END,
         CASE WHEN {_REACHED} < {POWER} THEN high ELSE (low + high) / 2.0 END, step + 1
  FROM halved WHERE step < 70
)"""]) + f"""
SELECT e.stratum, e.is_overall, control_total, treatment_total,
       round(p1, {DIGITS}) AS control_churn_rate, round(p2, {DIGITS}) AS treatment_churn_rate,
       round(cohens_h, {DIGITS}) AS cohens_h,
       round(high, {SAMPLE_DIGITS}) AS required_n_per_group,
       least(control_total, treatment_total) >= high AS adequately_powered
FROM effect e LEFT JOIN halved v ON e.stratum = v.stratum AND e.is_overall = v.is_overall AND step = 70"""


EXPERIMENT_OUTCOMES = _with(EXPERIMENTS) + """
SELECT experiment_id, outcome, CAST(pre_experiment_mrr AS DOUBLE) AS pre_experiment_mrr,
       CAST(renewal_mrr AS DOUBLE) AS renewal_mrr
FROM experiments"""

_SUBS_OUT = """
SELECT sub_id, account_id, opp_id, plan, CAST(mrr_cents AS DOUBLE) / 100.0 AS mrr,
       CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, status
FROM subs"""

SUBSCRIPTIONS_FROM_WINS = _with(SUBS) + _SUBS_OUT

HEALTH_SNAPSHOTS = _with(SUBS + SNAPS) + """
SELECT sub_id, account_id, CAST(start_date AS VARCHAR) AS start_date, status,
       CAST(end_date AS VARCHAR) AS end_date, CAST(snapshot_date AS VARCHAR) AS snapshot_date
FROM snaps"""

REVENUE_EVENTS_FROM_SUBS = _with(SUBS + f""",
ev AS (
  SELECT account_id, sub_id, unnest(['new', 'churn', 'expansion']) AS type,
         unnest([mrr_cents, CASE WHEN status = 'churned' THEN -mrr_cents END,
                 CASE WHEN status = 'active' AND grown_on < {AS_OF} THEN (grown_cents + 6) // 12 END])
           AS amount_cents,
         unnest([start_date, end_date, grown_on]) AS event_date
  FROM subs
)""") + """
SELECT sub_id || '-' || type || '-' || strftime(event_date, '%Y%m%d') AS event_id,
       account_id, sub_id, type, CAST(amount_cents AS DOUBLE) / 100.0 AS amount,
       CAST(event_date AS VARCHAR) AS event_date
FROM ev WHERE amount_cents IS NOT NULL"""

HEALTH_SCORES = _with(ACTIVITY) + """
SELECT account_id, usage_score, login_frequency_30d, support_tickets_30d,
       CAST(health_score AS DOUBLE) AS health_score, risk_tier
FROM scored_tier"""

EXPERIMENT_ASSIGNMENT = _with(HEALTH) + f"""
SELECT sub_id AS experiment_id, account_id, sub_id, risk_tier AS risk_tier_at_assignment,
       {_assign('sub_id')}, CAST(snapshot_date + 5 AS VARCHAR) AS assigned_date,
       CAST(mrr_cents AS DOUBLE) / 100.0 AS pre_experiment_mrr
FROM health WHERE health_score < 65"""

# as read back from CSV: a blank source is missing
LEADS_CSV_ROUND_TRIP = _with(LEADS) + """
SELECT lead_id, segment, CASE WHEN lead_source = '' THEN NULL
         ELSE concat_ws(chr(10), lead_source || ', "' || status || '"', segment) END AS lead_source,
       status, CAST(created_at AS VARCHAR) AS created_at
FROM leads"""

STG = {
    "stg_accounts": _with(ACCOUNTS) + """
SELECT account_id, company_name, segment, industry, region, CAST(arr AS DOUBLE) AS arr,
       CAST(signup_date AS VARCHAR) AS signup_date FROM accounts""",
    "stg_customer_health_scores": _with(HEALTH) + """
SELECT health_id, account_id, sub_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, usage_score,
       login_frequency_30d, support_tickets_30d, days_to_renewal,
       CAST(health_score AS DOUBLE) AS health_score, risk_tier FROM health""",
    "stg_leads": _with(LEADS) + """
SELECT lead_id, segment, lead_source, status, CAST(created_at AS VARCHAR) AS created_at FROM leads""",
    "stg_opportunities": _with(OPPS) + """
SELECT opp_id, lead_id, account_id, rep_id, segment, lead_source, plan, stage,
       CAST(amount AS DOUBLE) AS amount, CAST(created_date AS VARCHAR) AS created_date,
       CAST(close_date AS VARCHAR) AS close_date FROM opps""",
    "stg_retention_experiments": _with(EXPERIMENTS) + """
SELECT experiment_id, account_id, sub_id, risk_tier_at_assignment, variant, treatment_type,
       CAST(assigned_date AS VARCHAR) AS assigned_date,
       CAST(pre_experiment_mrr AS DOUBLE) AS pre_experiment_mrr, outcome,
       CAST(renewal_mrr AS DOUBLE) AS renewal_mrr FROM experiments""",
    "stg_revenue_events": _with(REVENUE) + """
SELECT event_id, account_id, sub_id, event_type, CAST(amount AS DOUBLE) AS amount,
       CAST(event_date AS VARCHAR) AS event_date FROM revenue_events""",
    "stg_subscriptions": _with(SUBS) + _SUBS_OUT,
    "stg_sales_reps": _with(REPS) + """
SELECT rep_id, rep_name, region, quota_quarterly, CAST(hire_date AS VARCHAR) AS hire_date FROM reps""",
}

ORACLE_SQL: dict[str, str] = {
    "leads_funnel": LEADS_FUNNEL,
    "conversion_rates": CONVERSION_RATES,
    "qualified_leads": QUALIFIED_LEADS,
    "data_quality": DATA_QUALITY,
    "kpi_scorecard": KPI_SCORECARD,
    "funnel_long": FUNNEL_LONG,
    "sales_cycle": SALES_CYCLE,
    "win_rate": WIN_RATE,
    "mrr_waterfall": MRR_WATERFALL,
    "churn_ab_results": CHURN_AB_RESULTS,
    "ab_significance": AB_SIGNIFICANCE,
    "ab_power": AB_POWER,
    "experiment_outcomes": EXPERIMENT_OUTCOMES,
    "subscriptions_from_wins": SUBSCRIPTIONS_FROM_WINS,
    "health_snapshots": HEALTH_SNAPSHOTS,
    "revenue_events_from_subs": REVENUE_EVENTS_FROM_SUBS,
    "health_scores": HEALTH_SCORES,
    "experiment_assignment": EXPERIMENT_ASSIGNMENT,
    "leads_csv_round_trip": LEADS_CSV_ROUND_TRIP,
    "churn_ab_from_tables": CHURN_AB_RESULTS,
    **STG,
}
