"""Retention experiment: eligibility, assignment, outcomes and statistics.

BR7-BR9 build experiment rows; ST1-ST8 test them. The reference runs its
tests on the driver, one stratum at a time, over rows fetched from the mart.
Here every stratum (each risk tier and the overall roll-up) is one row of a
DataFrame and every statistic is a column, so nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ColumnOrName, col
from ..functions.stats import (cohens_h_sql, n_per_group_sql, newcombe_sql, newton_step_sql,
                               pooled_z_sql, ratio_sql, two_sided_p_sql, wilson_sql)

# --- fixed values: eligible tiers, variants, treatments --------------------
ELIGIBLE_TIERS = ["high_risk", "watch"]
CONTROL, TREATMENT = "control", "treatment"
NO_TREATMENT = "none"
RETENTION_TREATMENTS = ["csm_strategic_call", "audit_prep_discount_10pct",
                        "free_extra_framework_addon"]
# ---------------------------------------------------------------------------
NEWTON_STEPS = 3    # from the closed form: quadratic convergence, exact to double precision


KEY_BITS = 1 << 22  # bits of a key filter: at most 65,536 rows of 64


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BITS))


def key_filter(rows: DataFrame, key: str) -> DataFrame:
    """(word, mask): a bit set of the hashes of `key`, 1 MB whatever the input's size."""
    slot = _slot(key)
    return rows.select((slot / 64).cast("int").alias("word"),
                       F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({key}), {KEY_BITS}) % 64 AS INT))").alias("bit")
                       ).groupBy("word").agg(F.bit_or("bit").alias("mask"))


def may_match(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose key may be in the filter: all that are, few others. The filter
    is broadcast: it has at most KEY_BITS / 64 rows."""
    columns = rows.columns
    hit = F.expr(f"shiftright(mask, CAST(pmod(xxhash64({key}), {KEY_BITS}) % 64 AS INT)) & 1") == 1
    return rows.withColumn("word", (_slot(key) / 64).cast("int")).join(
        F.broadcast(keys), "word").filter(hit).select(*columns)


def eligible_for_experiment(health: DataFrame, subs: DataFrame,
                            assignment_lag_days: int = 5, strict: bool = True,
                            reduce: bool = False) -> DataFrame:
    """BR7 (FLT4 + JN1): at-risk snapshots with their subscription's mrr.

    Output: account_id, sub_id, risk_tier_at_assignment, assigned_date,
    pre_experiment_mrr. The subscription lookup is an equi-join on sub_id. A
    snapshot whose subscription is missing fails the job, as it does in the
    reference; `strict=False` leaves such snapshots out instead.

    `reduce` filters the subscriptions by the at-risk snapshots' keys before
    they are shuffled. The snapshots are read twice for it, so it pays where
    they are a stored table and few of many are at risk.
    """
    at_risk = health.filter(F.col("risk_tier").isin(ELIGIBLE_TIERS))
    mrr = subs.select("sub_id", F.col("mrr").alias("pre_experiment_mrr"),
                      F.lit(True).alias("_found"))
    if reduce:
        mrr = may_match(mrr, "sub_id", key_filter(at_risk, "sub_id"))
    joined = at_risk.join(mrr, "sub_id", "left" if strict else "inner")
    if strict:
        missing = F.concat(F.lit("no subscription "), F.coalesce("sub_id", F.lit("NULL")))
        joined = joined.withColumn("pre_experiment_mrr", F.when(
            F.col("_found").isNull(), F.raise_error(missing).cast(subs.schema["mrr"].dataType))
            .otherwise(F.col("pre_experiment_mrr")))
    return joined.select(
        "account_id", "sub_id",
        F.col("risk_tier").alias("risk_tier_at_assignment"),
        F.date_add("snapshot_date", assignment_lag_days).alias("assigned_date"),
        "pre_experiment_mrr",
    )


def _hex_int(h: Column, start: int) -> Column:
    """8 hex digits of h from 1-based `start`, as a non-negative bigint."""
    return F.conv(F.substring(h, start, 8), 16, 10).cast("bigint")


def assign_variant(df: DataFrame, key: ColumnOrName, salt: str,
                   treatments: list[str] | None = None,
                   control_share: float = 0.5) -> DataFrame:
    """BR8: deterministic split into control / treatment.

    The unit's bucket is the first 32 bits of md5('<salt>:<key>'), so a unit
    lands in the same arm on every run, retry and partitioning (unlike rand()).
    Control gets treatment_type 'none'; treatment gets one of `treatments`,
    picked by the next 32 bits.
    """
    treatments = treatments or RETENTION_TREATMENTS
    h = F.md5(F.concat(F.lit(salt + ":"), col(key).cast("string")))
    is_control = _hex_int(h, 1) < F.lit(int(control_share * 2 ** 32))
    pick = F.element_at(F.array(*[F.lit(t) for t in treatments]),
                        (_hex_int(h, 9) % F.lit(len(treatments)) + F.lit(1)).cast("int"))
    return df.withColumns({
        "variant": F.when(is_control, F.lit(CONTROL)).otherwise(F.lit(TREATMENT)),
        "treatment_type": F.when(is_control, F.lit(NO_TREATMENT)).otherwise(pick),
    })


def renewal_mrr(outcome: ColumnOrName, mrr: ColumnOrName) -> Column:
    """BR9: 0 if churned, otherwise the pre-experiment mrr."""
    return (F.when(col(outcome) == "churned", F.lit(0))
             .otherwise(col(mrr))).cast("decimal(18,2)")


def experiment_outcomes(experiments: DataFrame) -> DataFrame:
    """BR9 applied: recompute renewal_mrr from outcome and pre-experiment mrr."""
    return experiments.withColumn("renewal_mrr",
                                  renewal_mrr("outcome", "pre_experiment_mrr"))


def _arms(mart: DataFrame) -> DataFrame:
    """One row per tier plus an overall roll-up, with both arms side by side.

    `grouping_id` tells the overall row apart from a real NULL tier. A missing
    arm leaves its columns NULL, and so every statistic that needs it.
    """
    def arm(name: str, column: str) -> Column:
        return F.expr(f"sum(CASE WHEN variant = '{name}' THEN {column} END)")

    rolled = mart.rollup("risk_tier_at_assignment").agg(
        arm(CONTROL, "churned_count").alias("control_churned"),
        arm(CONTROL, "total_accounts").alias("control_total"),
        arm(TREATMENT, "churned_count").alias("treatment_churned"),
        arm(TREATMENT, "total_accounts").alias("treatment_total"),
        F.grouping_id().alias("_level"),
    )
    return rolled.selectExpr(
        "CASE WHEN _level = 1 THEN 'overall' ELSE risk_tier_at_assignment END AS stratum",
        "_level = 1 AS is_overall",
        "control_churned", "control_total", "treatment_churned", "treatment_total",
        f"{ratio_sql('control_churned', 'control_total')} AS control_churn_rate",
        f"{ratio_sql('treatment_churned', 'treatment_total')} AS treatment_churn_rate",
    )


def _presentation_order(df: DataFrame) -> DataFrame:
    """Tiers first, the overall row last."""
    return df.orderBy("is_overall", F.col("stratum").asc_nulls_last())


def ab_significance(mart: DataFrame, alpha: float = 0.05) -> DataFrame:
    """ST1-ST4, ST7, ST8, MRT10 over the churn A/B mart (MRT5).

    Per stratum: arm counts and churn rates, rate_difference (control minus
    treatment, positive = treatment churns less), pooled two-proportion z and
    its two-sided p-value, `significant` (p < alpha), Wilson intervals per arm
    and a Newcombe interval for the difference.
    """
    cc, nc, ct, nt = "control_churned", "control_total", "treatment_churned", "treatment_total"
    lo_c, hi_c = wilson_sql(cc, nc, alpha)
    lo_t, hi_t = wilson_sql(ct, nt, alpha)
    tested = _arms(mart).selectExpr(
        "*",
        "control_churn_rate - treatment_churn_rate AS rate_difference",
        f"{pooled_z_sql(cc, nc, ct, nt)} AS z_stat",
        f"{lo_c} AS control_ci_low", f"{hi_c} AS control_ci_high",
        f"{lo_t} AS treatment_ci_low", f"{hi_t} AS treatment_ci_high",
    )
    lo_d, hi_d = newcombe_sql("control_churn_rate", "control_ci_low", "control_ci_high",
                              "treatment_churn_rate", "treatment_ci_low", "treatment_ci_high")
    out = tested.selectExpr("*", f"{lo_d} AS diff_ci_low", f"{hi_d} AS diff_ci_high",
                            f"{two_sided_p_sql('z_stat')} AS p_value")
    return _presentation_order(out.selectExpr("*", f"p_value < {alpha!r}D AS significant"))


def ab_power(mart: DataFrame, alpha: float = 0.05, power: float = 0.80,
             exact: bool = True) -> DataFrame:
    """ST5 + ST6 per stratum: Cohen's h of the observed rates and the sample
    size per group needed for `power` at two-sided `alpha`, next to the actual
    arm sizes.

    The size solves the full two-sided power function, as the reference's solver
    does: the closed form 2((z_(1-alpha/2) + z_power)/|h|)^2, which ignores the
    opposite tail, refined by Newton steps (the two differ by about 0.0024 at
    n ~ 1015). `exact=False` gives the closed form alone.
    """
    h = _arms(mart).selectExpr(
        "stratum", "is_overall", "control_total", "treatment_total", "control_churn_rate",
        "treatment_churn_rate",
        f"{cohens_h_sql('control_churn_rate', 'treatment_churn_rate')} AS cohens_h")
    need = h.selectExpr("*", f"{n_per_group_sql('cohens_h', alpha, power)} AS required_n_per_group")
    if exact:
        # a fold, so that a step names its start instead of repeating it
        step = newton_step_sql("n", "cohens_h", alpha, power)
        need = need.withColumn("required_n_per_group", F.expr(
            f"aggregate(sequence(1, {NEWTON_STEPS}), required_n_per_group, (n, i) -> {step})"))
    out = need.selectExpr(
        "*", "least(control_total, treatment_total) >= required_n_per_group AS adequately_powered")
    return _presentation_order(out)


def build_experiments(eligible: DataFrame, key: ColumnOrName, salt: str,
                      experiment_id: ColumnOrName | None = None) -> DataFrame:
    """BR7 output + BR8 assignment, in the retention_experiments column order
    (outcome and renewal_mrr are not known yet at assignment)."""
    assigned = assign_variant(eligible, key, salt)
    eid = col(experiment_id) if experiment_id is not None else col(key).cast("string")
    return assigned.select(
        eid.alias("experiment_id"), "account_id", "sub_id", "risk_tier_at_assignment",
        "variant", "treatment_type", "assigned_date", "pre_experiment_mrr")

