"""Command line: the reference's three steps, plus export.

    python -m revops_spark load    --csv-dir DIR [--format csv|parquet] [--schema raw]
                                   [--mode overwrite|append] [--repeat] [--buckets N]
                                   [--single-line]
    python -m revops_spark build   [--raw-schema raw] [--mart-schema mart] [--dashboard]
    python -m revops_spark ab-test [--mart-schema mart] [--alpha 0.05] [--power 0.8]
                                   [--closed-form-power]
    python -m revops_spark export  --table mart.fct_mrr_waterfall --out DIR

    python -m revops_spark all     --csv-dir DIR [--format ...] [--buckets N] [--dashboard]

The session comes from `SparkSession.builder.getOrCreate()`, so spark-submit
(or the cluster's defaults) decides master, resources and checkpoint folder.
Separate commands share tables through the session catalog, which must persist
between processes (a metastore, as on a cluster); with Spark's in-memory
catalog, `all` runs load, build and ab-test in one session instead.
Only `ab-test` shows rows on the console: one per stratum.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from revops_spark.plans.build import run_ab_analysis, run_build
from revops_spark.session import configure
from revops_spark.sources.files import export_csv, load_all


def _loaded(report: DataFrame) -> None:
    """Show the load report (one row per table); exit with 1 if a table failed."""
    report.show(truncate=False)
    if not report.filter("status = 'failed'").isEmpty():
        raise SystemExit(1)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="revops_spark")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("load", help="load the 8 raw CSV tables in dependency order")
    p.add_argument("--csv-dir", required=True, help="folder holding <table>.csv (or .parquet)")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--schema", default="raw")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--repeat", action="store_true",
                   help="append files that an earlier load appended once more")
    p.add_argument("--buckets", type=int, default=None,
                   help="bucket the joined tables by their join key (co-located join)")
    p.add_argument("--single-line", action="store_true",
                   help="no field holds a line end, so large CSV files are split")
    p = sub.add_parser("build", help="staging views and the mart tables")
    p.add_argument("--raw-schema", default="raw")
    p.add_argument("--mart-schema", default="mart")
    p.add_argument("--dashboard", action="store_true",
                   help="also write the dashboard figures (KPI scorecard, funnel, win rate)")
    p = sub.add_parser("ab-test", help="significance and power of the retention experiment")
    p.add_argument("--mart-schema", default="mart")
    p.add_argument("--alpha", type=float, default=0.05)
    p.add_argument("--power", type=float, default=0.80)
    p.add_argument("--closed-form-power", action="store_true",
                   help="sample size by the closed form, not solved with both tails")
    p = sub.add_parser("all", help="load, build and ab-test in one session")
    p.add_argument("--csv-dir", required=True, help="folder holding <table>.csv (or .parquet)")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--buckets", type=int, default=None)
    p.add_argument("--single-line", action="store_true")
    p.add_argument("--dashboard", action="store_true")
    p.add_argument("--closed-form-power", action="store_true")
    p = sub.add_parser("export", help="write a table as CSV with a header")
    p.add_argument("--table", required=True)
    p.add_argument("--out", required=True)
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("revops_spark").getOrCreate())
    if args.command == "load":
        _loaded(load_all(spark, args.csv_dir, args.schema, args.mode, args.buckets, args.format,
                         not args.single_line, args.repeat))
    elif args.command == "build":
        run_build(spark, raw_schema=args.raw_schema, mart_schema=args.mart_schema,
                  dashboard=args.dashboard).show(truncate=False)
    elif args.command == "ab-test":
        significance, power = run_ab_analysis(spark, args.mart_schema, args.alpha, args.power,
                                              not args.closed_form_power)
        significance.show(truncate=False)
        power.show(truncate=False)
    elif args.command == "all":
        _loaded(load_all(spark, args.csv_dir, "raw", "overwrite", args.buckets, args.format,
                         not args.single_line))
        run_build(spark, raw_schema="raw", mart_schema="mart",
                  dashboard=args.dashboard).show(truncate=False)
        significance, power = run_ab_analysis(spark, "mart", exact_power=not args.closed_form_power)
        significance.show(truncate=False)
        power.show(truncate=False)
    elif args.command == "export":
        export_csv(spark.table(args.table), args.out)


if __name__ == "__main__":
    main()
