"""Staged swaps, the load log, parallel loads, and the order layout."""

import os
import threading
import time

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revops_spark.operators import experiments as ex
from revops_spark.plans import queries
from revops_spark.sources import files, layout
from revops_spark.sources import testdata as td
from revops_spark.sources.schemas import LOAD_ORDER, PARENTS

from conftest import SF_SMALL
from test_sources import _sample_csvs, _write

HEADER = "lead_id,segment,lead_source,status,created_at\n"


def ids(spark, name, column="x"):
    return sorted(r[0] for r in spark.table(name).select(column).collect())


def tables(spark, schema):
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


# --- SNK6: a rebuild that fails keeps the former table ------------------------------
def failing(spark, good=5):
    """Writes some rows, then fails."""
    bad = F.when(F.col("id") >= good, F.raise_error(F.lit("lost midway"))).otherwise(F.col("id"))
    return spark.range(0, 40, 1, 8).select(bad.cast("int").alias("x"))


def test_failed_overwrite_keeps_the_former_rows(spark):
    files.write_table(spark.createDataFrame([(1,), (2,)], "x int"), "swap_t", "t")
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.write_table(failing(spark), "swap_t", "t")
    assert ids(spark, "swap_t.t") == [1, 2]
    assert tables(spark, "swap_t") == ["t"]                  # nothing half written stays
    assert files.write_table(spark.createDataFrame([(3,)], "x int"), "swap_t", "t") == 1
    assert ids(spark, "swap_t.t") == [3] and tables(spark, "swap_t") == ["t"]


def test_failed_switch_gives_the_name_back(spark, monkeypatch):
    files.write_table(spark.createDataFrame([(1,)], "x int"), "swap_s", "t")
    sql = type(spark).sql

    def broken(self, query, *args, **kw):
        if "RENAME TO `swap_s`.`t`" in query and "_new_" in query:
            raise RuntimeError("catalogue away")
        return sql(self, query, *args, **kw)

    monkeypatch.setattr(type(spark), "sql", broken)
    with pytest.raises(RuntimeError):
        files.write_table(spark.createDataFrame([(2,)], "x int"), "swap_s", "t")
    monkeypatch.undo()
    assert ids(spark, "swap_s.t") == [1]


def test_a_switch_left_half_done_is_recovered(spark):
    files.write_table(spark.createDataFrame([(1,)], "x int"), "swap_r", "t")
    spark.sql("ALTER TABLE swap_r.t RENAME TO swap_r.t_old")         # the driver was lost here
    assert files.recover_table(spark, "swap_r", "t")
    assert ids(spark, "swap_r.t") == [1] and not files.recover_table(spark, "swap_r", "t")


def test_an_overwrite_may_read_its_own_table(spark):
    files.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "x int, s string"), "swap_o", "t")
    grown = spark.table("swap_o.t").select((F.col("x") * 10).alias("x"))   # another schema, too
    assert files.write_table(grown, "swap_o", "t") == 2
    assert ids(spark, "swap_o.t") == [10, 20] and spark.table("swap_o.t").columns == ["x"]


# --- SNK2: a repeated append is recognised --------------------------------------------
def test_two_appends_of_one_file_hold_its_rows_once(spark, tmp_dir):
    p = os.path.join(tmp_dir, "leads.csv")
    _write(p, HEADER + "L1,SMB,x,New,2024-01-02\nL2,SMB,y,MQL,2024-01-03\n")
    assert files.append_load(spark, p, "leads", "log_a") == (2, "loaded")
    assert files.append_load(spark, p, "leads", "log_a") == (0, "repeated")
    assert ids(spark, "log_a.leads", "lead_id") == ["L1", "L2"]
    assert files.append_load(spark, p, "leads", "log_a", repeat=True) == (2, "loaded")   # when asked
    assert ids(spark, "log_a.leads", "lead_id") == ["L1", "L1", "L2", "L2"]
    _write(p, HEADER + "L3,SMB,x,New,2024-01-02\n")                                      # other content
    assert files.append_load(spark, p, "leads", "log_a") == (1, "loaded")
    assert files.overwrite_load(spark, p, "leads", "log_a") == (1, "loaded")             # starts anew
    assert files.append_load(spark, p, "leads", "log_a") == (1, "loaded")
    assert files.append_load(spark, p, "leads", "log_a") == (0, "repeated")
    assert ids(spark, "log_a.leads", "lead_id") == ["L3", "L3"]


@pytest.mark.parametrize("arrived", [True, False])
def test_a_load_lost_before_its_commit_row(spark, tmp_dir, monkeypatch, arrived):
    """The driver is lost after the rows were committed, or before."""
    schema = f"log_lost_{arrived}".lower()
    p = os.path.join(tmp_dir, "leads.csv")
    _write(p, HEADER + "L1,SMB,x,New,2024-01-02\n")
    write = files.write_table

    def lost(*args, **kw):
        if arrived:
            write(*args, **kw)
        raise KeyboardInterrupt

    monkeypatch.setattr(files, "write_table", lost)
    with pytest.raises(KeyboardInterrupt):
        files.append_load(spark, p, "leads", schema)
    monkeypatch.undo()
    assert files.append_load(spark, p, "leads", schema) == ((0, "repeated") if arrived else (1, "loaded"))
    assert files.append_load(spark, p, "leads", schema) == (0, "repeated")
    assert ids(spark, f"{schema}.leads", "lead_id") == ["L1"]


def test_repeated_load_of_all_tables(spark, tmp_dir):
    _sample_csvs(tmp_dir)
    first = files.load_all(spark, tmp_dir, "log_all", "append").collect()
    again = files.load_all(spark, tmp_dir, "log_all", "append").collect()
    assert [r.table_name for r in again] == LOAD_ORDER
    assert {r.status for r in first} == {"loaded"} and {r.status for r in again} == {"repeated"}
    assert all(r.rows_loaded == 0 for r in again)
    assert spark.table("log_all.leads").count() == 2
    asked = files.load_all(spark, tmp_dir, "log_all", "append", repeat=True).collect()
    assert {r.status for r in asked} == {"loaded"} and spark.table("log_all.leads").count() == 4


# --- SNK3: waves, at the same time ------------------------------------------------------
def test_waves_keep_parents_first():
    waves = files.load_waves()
    at = {t: i for i, wave in enumerate(waves) for t in wave}
    assert sorted(at) == sorted(LOAD_ORDER)
    assert all(at[p] < at[t] for t, parents in PARENTS.items() for p in parents)
    assert len(waves) < len(LOAD_ORDER)


def test_tables_of_a_wave_load_at_the_same_time(spark, tmp_dir, monkeypatch):
    """Same report as one after the other, children after their parents, and shorter."""
    _sample_csvs(tmp_dir)
    spans, read, lock = {}, files.read_raw_files, threading.Lock()

    def slow(spark, path, table, *args):
        begin = time.monotonic()
        time.sleep(0.5)
        with lock:
            spans[table] = (begin, time.monotonic())
        return read(spark, path, table, *args)

    monkeypatch.setattr(files, "read_raw_files", slow)
    took, reports = {}, {}
    for n in (1, 4):
        t0 = time.monotonic()
        reports[n] = sorted(map(tuple, files.load_all(spark, tmp_dir, f"par_{n}", concurrent=n).collect()), key=repr)
        took[n] = time.monotonic() - t0
    assert reports[1] == reports[4] and took[4] < took[1] - 1
    assert all(spans[p][1] <= spans[t][0] for t, parents in PARENTS.items() for p in parents)
    assert spans["accounts"][0] < spans["sales_reps"][1] and spans["sales_reps"][0] < spans["accounts"][1]


# --- SRC1: large files without line ends in fields are split ------------------------------
def test_single_line_files_are_split(spark, tmp_dir):
    _sample_csvs(tmp_dir)
    p = os.path.join(tmp_dir, "leads.csv")
    _write(p, HEADER + "".join(f"L{i},SMB,x,New,2024-01-02\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert files.read_raw_files(spark, p, "leads").rdd.getNumPartitions() == 1
        assert files.read_raw_files(spark, p, "leads", multi_line=False).rdd.getNumPartitions() > 4
        report = {r.table_name: r.rows_loaded for r in files.load_all(
            spark, tmp_dir, "split_t", multi_line=False).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert report["leads"] == 20_000 == spark.table("split_t.leads").select("lead_id").distinct().count()


# --- SNK1: the former export stays until the new one has its place ------------------------
def test_failed_replacement_keeps_the_former_export(spark, tmp_dir, monkeypatch):
    out = os.path.join(tmp_dir, "out")
    assert files.export_csv(spark.createDataFrame([(1,)], "x int"), out)
    filesystem = files._filesystem

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def move(self, a, b):
            if b == out and ".old-" not in a:
                raise OSError("storage away")
            return self.fs.move(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    monkeypatch.setattr(files, "_filesystem", lambda p: (Broken(filesystem(p)[0]), filesystem(p)[1]))
    with pytest.raises(OSError):
        files.export_csv(spark.createDataFrame([(2,)], "x int"), out)
    monkeypatch.undo()
    assert [r.x for r in spark.read.option("header", True).csv(out).collect()] == ["1"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.export_csv(failing(spark), out)
    assert [r.x for r in spark.read.option("header", True).csv(out).collect()] == ["1"]
    assert files.export_csv(spark.createDataFrame([(3,)], "x int"), f"file://{out}")
    assert [r.x for r in spark.read.option("header", True).csv(out).collect()] == ["3"]


# --- the order layout: roll-up and join without an exchange ---------------------------------
@pytest.fixture(scope="module")
def laid_out(spark):
    return layout.write_order_layout(spark, SF_SMALL, "orders_t", 4)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_layout_needs_no_exchange(spark, laid_out, no_broadcast):
    won = td.opportunities(spark, laid_out, ["Closed Won"], with_segment=False)
    plan = physical(won)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert physical(td.opportunities(spark, SF_SMALL, ["Closed Won"], with_segment=False)).count("Exchange") >= 2
    for df in (td.subscriptions(spark, laid_out), td.lifecycle_revenue_events(spark, laid_out)):
        assert "Exchange" not in physical(df)


def test_order_layout_gives_the_same_rows(spark, laid_out):
    for name in ("sales_cycle", "stg_opportunities", "revenue_events_from_subs", "churn_ab_results"):
        query = queries.QUERIES[name]
        assert sorted(map(tuple, query(spark, laid_out).collect()), key=repr) == \
            sorted(map(tuple, query(spark, SF_SMALL).collect()), key=repr), name


def test_loaded_orders_and_their_events_are_co_located(spark, tmp_dir, no_broadcast):
    _sample_csvs(tmp_dir)
    files.load_all(spark, tmp_dir, "raw_o", buckets=4)
    paid = spark.table("raw_o.revenue_events").groupBy(F.col("sub_id").alias("opp_id")).agg(F.sum("amount").alias("paid"))
    plan = physical(spark.table("raw_o.opportunities").join(paid, "opp_id", "left"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan


# --- one pass over the line items ------------------------------------------------------------
@pytest.mark.parametrize("name", ["subscriptions_from_wins", "revenue_events_from_subs", "health_snapshots",
                                  "stg_subscriptions", "stg_customer_health_scores"])
def test_line_items_are_read_once(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1, plan


# --- JN1: the at-risk snapshots' keys filter the subscriptions --------------------------------
def test_key_filter_loses_no_key(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("word"))
    found = ex.may_match(rows, "k", ex.key_filter(keys, "k"))
    assert found.columns == ["k", "word"]
    left = {r.k for r in found.collect()}
    assert {str(i) for i in range(0, 3000, 3)} <= left and len(left) < 1100
    assert ex.may_match(rows, "k", ex.key_filter(keys.limit(0), "k")).count() == 0
    assert ex.key_filter(keys.union(keys), "k").count() <= ex.KEY_BITS // 64


def test_reduced_eligibility_equals_the_plain_one(spark, no_broadcast):
    subs = td.subscriptions(spark, SF_SMALL)
    health = td.health(spark, SF_SMALL, subs)
    plain = sorted(map(tuple, ex.eligible_for_experiment(health, subs).collect()))
    assert plain and sorted(map(tuple, ex.eligible_for_experiment(health, subs, reduce=True).collect())) == plain
    # a snapshot without its subscription still fails the job, or is left out
    fewer = subs.filter(F.col("sub_id") != plain[0][1])
    with pytest.raises((PySparkException, Py4JJavaError), match="no subscription"):
        ex.eligible_for_experiment(health, fewer, reduce=True).collect()
    loose = ex.eligible_for_experiment(health, fewer, strict=False, reduce=True)
    assert loose.count() == len(plain) - 1


# --- from tables to the mart: shared work, steps at the same time -----------------------------
def test_line_items_are_rolled_up_once(spark, monkeypatch):
    """Three adapters need the roll-up; two others read the line items for their own ends."""
    real, read = td.table, []
    monkeypatch.setattr(td, "table", lambda s, d, name: (read.append(name), real(s, d, name))[1])
    got = sorted(map(tuple, queries.churn_ab_from_tables(spark, SF_SMALL).collect()), key=repr)
    assert read.count("lineitem") == 3
    monkeypatch.undo()
    assert got == sorted(map(tuple, queries.churn_ab_results(spark, SF_SMALL).select(
        *files.AB_COLUMNS).collect()), key=repr)


def test_adapters_over_a_stored_rollup(spark, tmp_dir):
    rolled = layout.store_rollup(spark, SF_SMALL, os.path.join(tmp_dir, "lines"))
    for name in ("opportunities", "subscriptions", "customer_health_scores"):
        a, b = (td.RAW_ADAPTERS[name](spark, d) for d in (SF_SMALL, rolled))
        assert a.schema == b.schema and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_the_build_rolls_up_what_it_uses(spark, monkeypatch):
    """The accepted lines' amount, which no raw table holds, is not computed."""
    stored, real = [], layout.store_rollup
    monkeypatch.setattr(layout, "store_rollup", lambda *a, **k: stored.append(real(*a, **k)) or stored[-1])
    queries.churn_ab_from_tables(spark, SF_SMALL)
    got = stored[0].rolled_up(spark)
    assert got.columns == ["o_orderkey", "last_ship", "cancelled_on"]
    whole = td.line_rollup(spark, SF_SMALL).select(got.columns)
    assert got.count() and got.exceptAll(whole).count() == whole.exceptAll(got).count() == 0


def test_jobs_at_the_same_time(spark):
    """They overlap, results keep the names' order, and a failure is raised."""
    met = threading.Barrier(3, timeout=30)
    assert files.at_the_same_time(spark, lambda name: (met.wait(), name)[1], ["a", "b", "c"], 3) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="b"):
        files.at_the_same_time(spark, lambda name: {"a": 1}[name] if name == "a" else int(name), ["a", "b"], 2)
