import csv
import datetime as dt
import os
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from revops_spark.plans import build
from revops_spark.sources import files
from revops_spark.sources.schemas import LOAD_ORDER, RAW_TABLES


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_blanks_and_types(spark, tmp_dir):
    p = os.path.join(tmp_dir, "leads.csv")
    _write(p, "lead_id,segment,lead_source,status,created_at\n"
              "L1,SMB,,New,2024-01-02\n"
              'L2,SMB,"",MQL,2024-01-03\n'
              "L3,SMB,none,SQL,\n")
    rows = {r.lead_id: r for r in files.read_csv_table(spark, p, "leads").collect()}
    assert rows["L1"].lead_source is None and rows["L2"].lead_source is None
    assert rows["L3"].lead_source == "none" and rows["L3"].created_at is None
    assert rows["L1"].created_at == dt.date(2024, 1, 2)


def test_upper_case_header_is_normalised(spark, tmp_dir):
    p = os.path.join(tmp_dir, "reps.csv")
    _write(p, "REP_ID,NAME,REGION,QUOTA_QUARTERLY,HIRE_DATE\nREP-0001,Allison Hill,West,150000,2023-07-18\n")
    df = files.read_csv_table(spark, p, "sales_reps")
    assert df.columns == ["rep_id", "name", "region", "quota_quarterly", "hire_date"]
    assert df.first().quota_quarterly == 150000


def test_columns_are_matched_by_header_name(spark, tmp_dir):
    p = os.path.join(tmp_dir, "leads.csv")
    _write(p, "Status,lead_source,lead_id,created_at,segment\nNew,Paid Search,L1,2024-01-02,SMB\n")
    df = files.read_csv_table(spark, p, "leads")
    assert df.columns == ["lead_id", "segment", "lead_source", "status", "created_at"]
    assert tuple(df.first()) == ("L1", "SMB", "Paid Search", "New", dt.date(2024, 1, 2))
    _write(p, "status,source,lead_id,created_at,segment\nNew,Paid Search,L1,2024-01-02,SMB\n")
    with pytest.raises(ValueError, match="source"):
        files.read_csv_table(spark, p, "leads")


def test_files_of_a_folder_must_agree(spark, tmp_dir):
    d = os.path.join(tmp_dir, "leads.csv")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv"), "lead_id,segment,lead_source,status,created_at\nL1,SMB,x,New,\n")
    _write(os.path.join(d, "b.csv"), "segment,lead_id,lead_source,status,created_at\nSMB,L2,x,New,\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv_table(spark, d, "leads").collect()


def test_quotes_commas_and_line_ends_both_ways(spark, tmp_dir):
    """A file as Python's csv writer makes it, and one of our own, read back whole."""
    names = ['Foo "Bar", Inc', "two\nlines", 'back\\slash "q"', "plain"]
    rows = [(f"A{i}", n, "SMB", "FinTech", "West", Decimal("1.50"), dt.date(2024, 1, 1))
            for i, n in enumerate(names)]
    p = os.path.join(tmp_dir, "accounts.csv")
    with open(p, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow([c.name for c in RAW_TABLES["accounts"].fields])
        w.writerows(rows)
    read = files.read_csv_table(spark, p, "accounts")
    assert sorted(map(tuple, read.collect())) == rows
    out = os.path.join(tmp_dir, "out")
    assert files.export_csv(read, out)
    assert sorted(map(tuple, files.read_csv_table(spark, out, "accounts").collect())) == rows


def test_export_runs_its_input_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).repartition(3).mapInArrow(note, "id long")
    out = os.path.join(tmp_dir, "once")
    assert files.export_csv(df, out) and seen.value == 100
    # an empty input leaves what is there
    assert files.export_csv(df.filter("id < 0"), out) is False
    assert spark.read.option("header", True).csv(out).count() == 100
    assert [x for x in os.listdir(tmp_dir) if x.startswith("once")] == ["once"]


def test_one_bad_table_does_not_end_the_load(spark, tmp_dir):
    _sample_csvs(tmp_dir)
    _write(os.path.join(tmp_dir, "accounts.csv"), "account_id,nonsense\nA1,x\n")
    os.remove(os.path.join(tmp_dir, "sales_reps.csv"))
    report = {r.table_name: r for r in files.load_all(spark, tmp_dir, "raw_bad").collect()}
    assert list(report) == LOAD_ORDER
    assert {t for t, r in report.items() if r.status == "failed"} == {"accounts", "sales_reps"}
    assert report["accounts"].rows_loaded is None and "nonsense" in report["accounts"].error
    assert (report["leads"].rows_loaded, report["leads"].status, report["leads"].error) == (2, "loaded", None)
    # a second load by appending reports its own rows
    again = {r.table_name: r for r in files.load_all(spark, tmp_dir, "raw_bad", "append").collect()}
    assert again["leads"].rows_loaded == 2 and spark.table("raw_bad.leads").count() == 4


def test_layer_schema():
    assert files.layer_schema(None, "analytics") == "analytics"
    assert files.layer_schema("  mart ", "analytics") == "mart"


def _sample_csvs(d):
    day = "2024-01-05"
    data = {
        "sales_reps": "rep_id,name,region,quota_quarterly,hire_date\nR1,A,West,150000,2023-01-01\n",
        "accounts": "account_id,company_name,segment,industry,region,arr,signup_date\nA1,C,SMB,FinTech,West,1000.50,2024-01-01\n",
        "leads": f"lead_id,segment,lead_source,status,created_at\nL1,SMB,Paid Search,MQL,{day}\nL2,SMB,,Opportunity,{day}\n",
        "opportunities": ("opp_id,lead_id,account_id,rep_id,segment,lead_source,plan,stage,amount,created_date,close_date\n"
                          f"O1,L2,A1,R1,SMB,,SOC2 Starter,Closed Won,1200.00,{day},2024-01-20\n"),
        "subscriptions": "sub_id,account_id,opp_id,plan,mrr,start_date,end_date,status\nS1,A1,O1,SOC2 Starter,100.00,2024-01-20,,active\n",
        "revenue_events": f"event_id,account_id,sub_id,type,amount,event_date\nE1,A1,S1,new,100.00,2024-01-20\nE2,A1,S1,churn,-100.00,2024-03-02\n",
        "customer_health_scores": ("health_id,account_id,sub_id,snapshot_date,usage_score,login_frequency_30d,"
                                   "support_tickets_30d,days_to_renewal,health_score,risk_tier\n"
                                   "H1,A1,S1,2024-02-01,40,3,5,100,39.5,high_risk\n"),
        "retention_experiments": ("experiment_id,account_id,sub_id,risk_tier_at_assignment,variant,treatment_type,"
                                  "assigned_date,pre_experiment_mrr,outcome,renewal_mrr\n"
                                  "X1,A1,S1,high_risk,control,none,2024-02-06,100.00,churned,0.0\n"
                                  "X2,A1,S1,high_risk,treatment,csm_strategic_call,2024-02-06,100.00,renewed,100.00\n"),
    }
    for t, text in data.items():
        _write(os.path.join(d, f"{t}.csv"), text)


def test_load_build_and_ab_from_tables(spark, tmp_dir):
    _sample_csvs(tmp_dir)
    report = {r.table_name: r.rows_loaded for r in files.load_all(spark, tmp_dir, "raw_t").collect()}
    assert list(report) == LOAD_ORDER and report["leads"] == 2 and report["revenue_events"] == 2
    # overwrite by default: a second load does not duplicate rows
    files.load_all(spark, tmp_dir, "raw_t")
    assert spark.table("raw_t.leads").count() == 2
    marts = {r.mart: r.rows for r in build.run_build(spark, raw_schema="raw_t", mart_schema=" mart_t ").collect()}
    assert set(marts) == set(build.MARTS)
    assert spark.table("mart_t.fct_mrr_waterfall").count() == 2
    # lead marts built from the roll-up's table equal the row-level marts
    assert spark.table("mart_t.lead_tallies").agg({"n": "sum"}).first()[0] == 2
    from revops_spark.operators import marts as m
    stg_leads = spark.table("stg_leads")
    for name, mart in build.LEAD_MARTS.items():
        assert sorted(map(tuple, spark.table(f"mart_t.{name}").collect()), key=repr) == \
            sorted(map(tuple, mart(stg_leads).collect()), key=repr), name
    assert spark.catalog.tableExists("stg_revenue_events")          # staging is a view
    assert "event_type" in spark.table("stg_revenue_events").columns
    assert spark.table("stg_sales_reps").columns[1] == "rep_name"
    ab = files.fetch_ab_test_data(spark, "mart_t")
    assert ab.columns == files.AB_COLUMNS
    sig, power = build.run_ab_analysis(spark, "mart_t")
    overall = [r for r in sig.collect() if r.is_overall][0]
    assert (overall.control_churned, overall.control_total, overall.treatment_churned) == (1, 1, 0)
    assert power.count() == 2


def test_append_mode_duplicates(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "x int")
    assert files.write_table(df, "app_t", "t", "overwrite") == 1
    # each call reports the rows it wrote, not the table's
    assert files.write_table(df, "app_t", "t", "append") == 1
    assert files.write_table(df.filter("x > 5"), "app_t", "t", "append") == 0
    assert spark.table("app_t.t").count() == 2


def test_export_csv(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    empty = spark.createDataFrame([], RAW_TABLES["leads"])
    assert files.export_csv(empty, out) is False and not os.path.exists(out)
    df = spark.createDataFrame([("L1", "SMB", None, "New", dt.date(2024, 1, 1))], RAW_TABLES["leads"])
    assert files.export_csv(df, out) is True
    back = files.read_csv_table(spark, out, "leads").collect()
    assert back[0].lead_id == "L1" and back[0].lead_source is None
    amounts = spark.createDataFrame([("a", Decimal("1.50"))], "k string, v decimal(18,2)")
    assert files.export_csv(amounts, os.path.join(tmp_dir, "m"))


def test_command_line(spark, tmp_dir, capsys):
    from revops_spark.__main__ import main
    _sample_csvs(tmp_dir)
    main(["load", "--csv-dir", tmp_dir, "--schema", "cli_raw"])
    main(["build", "--raw-schema", "cli_raw", "--mart-schema", "cli_mart", "--dashboard"])
    from revops_spark.operators import marts as m
    assert spark.table("cli_mart.kpi_scorecard").first().total_leads == 2
    assert sorted(map(tuple, spark.table("cli_mart.funnel_long").collect())) == \
        sorted(map(tuple, m.funnel_long(spark.table("stg_leads")).collect()))
    assert spark.table("cli_mart.win_rate").first().win_rate_pct == 100.0
    main(["ab-test", "--mart-schema", "cli_mart"])
    main(["ab-test", "--mart-schema", "cli_mart", "--closed-form-power"])
    out = os.path.join(tmp_dir, "funnel_csv")
    main(["export", "--table", "cli_mart.fct_leads_funnel", "--out", out])
    printed = capsys.readouterr().out
    assert "retention_experiments" in printed and "overall" in printed
    back = spark.read.option("header", True).csv(out).collect()
    assert back[0].segment == "SMB" and back[0].total_leads == "2"


def test_bucketed_load_co_locates_the_health_join(spark, tmp_dir):
    """Subscriptions and health snapshots bucketed by sub_id: JN1 needs no shuffle."""
    from revops_spark.operators import experiments as ex
    _sample_csvs(tmp_dir)
    files.load_all(spark, tmp_dir, "raw_b", buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        eligible = ex.eligible_for_experiment(spark.table("raw_b.customer_health_scores"),
                                              spark.table("raw_b.subscriptions"))
        plan = eligible._jdf.queryExecution().executedPlan().toString()
        rows = eligible.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert [(r.sub_id, r.pre_experiment_mrr) for r in rows] == [("S1", Decimal("100.00"))]


def test_load_from_parquet_files(spark, tmp_dir):
    """The same 8 tables as Parquet files load to the same rows."""
    _sample_csvs(tmp_dir)
    files.load_all(spark, tmp_dir, "raw_csv")
    pq_dir = os.path.join(tmp_dir, "pq")
    for t in LOAD_ORDER:
        spark.table(f"raw_csv.{t}").write.parquet(os.path.join(pq_dir, f"{t}.parquet"))
    report = {r.table_name: r.rows_loaded for r in files.load_all(spark, pq_dir, "raw_pq", fmt="parquet").collect()}
    for t in LOAD_ORDER:
        assert report[t] == spark.table(f"raw_csv.{t}").count()
        assert sorted(map(tuple, spark.table(f"raw_pq.{t}").collect()), key=repr) == \
            sorted(map(tuple, spark.table(f"raw_csv.{t}").collect()), key=repr)


def test_command_line_in_a_fresh_process(tmp_dir):
    """`python -m revops_spark all` end to end in its own process and session."""
    import subprocess
    import sys
    from conftest import ROOT
    _sample_csvs(tmp_dir)
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "revops_spark", "all", "--csv-dir", tmp_dir,
                          "--dashboard"], env=env, cwd=tmp_dir, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "fct_churn_ab_test_results" in out.stdout and "overall" in out.stdout
    assert "kpi_scorecard" in out.stdout
