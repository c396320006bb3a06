"""The model build: raw tables -> staging views -> mart tables.

The reference's model graph has depth 2: every mart reads exactly one staging
model. Staging models are views (lazy projections, so a mart's scan is pruned
to the columns it uses); marts are written as Parquet tables, which also cuts
the lineage for everything that reads them afterwards (the A/B statistics).

Three marts read the leads. Instead of three scans, the leads are rolled up
once to their distinct attribute combinations (segments x sources x statuses x
days), written as the table `lead_tallies`, and the marts are computed from that
with weights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import experiments as ex
from ..operators import marts as m
from ..operators.staging import STAGING
from ..sources.files import (at_the_same_time, ensure_schema, export_csv, fetch_ab_test_data, layer_schema,
                             load_all, raw_table, write_table, write_view)

LEAD_TALLIES = "lead_tallies"

# marts computed from the leads roll-up, with weight="n"
LEAD_MARTS: dict[str, Callable[..., DataFrame]] = {
    "fct_leads_funnel": m.fct_leads_funnel,
    "agg_conversion_rates": m.agg_conversion_rates,
    "audit_data_quality_summary": m.audit_data_quality_summary,
}

# the dashboard figures (MRT7-MRT9), written only with dashboard=True; the two
# lead figures come from the same roll-up
DASHBOARD_LEAD_MARTS: dict[str, Callable[..., DataFrame]] = {
    "kpi_scorecard": m.kpi_scorecard,
    "funnel_long": m.funnel_long,
}
DASHBOARD_MARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    **{name: ("stg_leads", f) for name, f in DASHBOARD_LEAD_MARTS.items()},
    "win_rate": ("stg_opportunities", m.win_rate),
}

# mart name -> (staging model it reads, transform)
MARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    **{name: ("stg_leads", f) for name, f in LEAD_MARTS.items()},
    "agg_sales_cycle": ("stg_opportunities", m.agg_sales_cycle),
    # a table keeps no row order, so the models' ORDER BY is not executed on write
    "fct_mrr_waterfall": ("stg_revenue_events", lambda df: m.fct_mrr_waterfall(df, sort=False)),
    "fct_churn_ab_test_results": ("stg_retention_experiments",
                                  lambda df: m.fct_churn_ab_test_results(df, sort=False)),
}


def build_staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One staging view per raw table, registered as `stg_<table>`."""
    out = {}
    for table, model in STAGING.items():
        if table in raw:
            name = f"stg_{table}"
            out[name] = write_view(model(raw[table]), name)
    return out


def read_raw(spark: SparkSession, schema: str = "raw") -> dict[str, DataFrame]:
    return {t: raw_table(spark, t, schema) for t in STAGING}


def build_marts(spark: SparkSession, staging: dict[str, DataFrame],
                custom_schema: str | None = "mart", default_schema: str = "default",
                mode: str = "overwrite", only: list[str] | None = None,
                dashboard: bool = False) -> DataFrame:
    """Write each mart whose staging input is present (and, with `dashboard`,
    the dashboard figures); returns (mart, rows)."""
    schema = ensure_schema(spark, layer_schema(custom_schema, default_schema))
    models = {**MARTS, **(DASHBOARD_MARTS if dashboard else {})}
    weighted = {**LEAD_MARTS, **DASHBOARD_LEAD_MARTS}
    wanted = [n for n, (source, _) in models.items()
              if (not only or n in only) and source in staging]
    tallies = None
    if any(n in weighted for n in wanted):
        write_table(m.lead_tallies(staging["stg_leads"]), schema, LEAD_TALLIES, "overwrite")
        tallies = spark.table(f"`{schema}`.`{LEAD_TALLIES}`")

    def one(name: str) -> tuple[str, int]:
        source, transform = models[name]
        df = weighted[name](tallies, weight="n") if name in weighted else transform(staging[source])
        return name, write_table(df, schema, name, mode)

    report = at_the_same_time(spark, one, wanted)
    return spark.createDataFrame(report, "mart string, rows long")


def run_build(spark: SparkSession, raw: dict[str, DataFrame] | None = None,
              raw_schema: str = "raw", mart_schema: str | None = "mart",
              dashboard: bool = False) -> DataFrame:
    """Full rebuild, like a model run: staging views, then every mart table."""
    staging = build_staging(raw if raw is not None else read_raw(spark, raw_schema))
    return build_marts(spark, staging, mart_schema, dashboard=dashboard)


def load_and_build(spark: SparkSession, raw: dict[str, DataFrame], folder: str,
                   raw_schema: str, mart_schema: str) -> None:
    """The reference's steps from end to end: every raw table exported as CSV files
    into `folder`, loaded from there into catalogue tables, staging views and mart
    tables built on them. Exports run at the same time, as loads and marts do, so
    that cores one job leaves idle work on the next."""
    at_the_same_time(spark, lambda name: export_csv(raw[name], f"{folder}/{name}.csv", mode="errorifexists"),
                     list(raw))
    # the adapters' values hold no line end, so large files may be split
    failed = load_all(spark, folder, raw_schema, multi_line=False).filter("status = 'failed'").collect()
    if failed:
        raise ValueError(f"tables not loaded: {[(r.table_name, r.error) for r in failed]}")
    run_build(spark, raw_schema=raw_schema, mart_schema=mart_schema)


def run_ab_analysis(spark: SparkSession, mart_schema: str = "mart", alpha: float = 0.05,
                    power: float = 0.80, exact_power: bool = True) -> tuple[DataFrame, DataFrame]:
    """The A/B script: significance per tier and overall, then power, both read
    from the written mart table (SRC4)."""
    mart = fetch_ab_test_data(spark, mart_schema)
    return ex.ab_significance(mart, alpha), ex.ab_power(mart, alpha, power, exact_power)
