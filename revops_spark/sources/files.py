"""File and catalog sources and sinks (SRC1, SRC2, SRC4, SNK1-SNK7).

CSV files are read with a fixed schema (no inference pass); nothing passes
through the driver but headers, table names and row counts.
"""

from __future__ import annotations

import logging
import os
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pyarrow.fs
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import JOIN_KEYS, LOAD_ORDER, PARENTS, RAW_TABLES

log = logging.getLogger(__name__)
T_ = TypeVar("T_")

AB_MART = "fct_churn_ab_test_results"
AB_COLUMNS = ["variant", "risk_tier_at_assignment", "total_accounts", "churned_count",
              "renewed_count", "churn_rate_pct", "total_pre_experiment_mrr",
              "total_retained_mrr"]


def normalise_columns(df: DataFrame) -> DataFrame:
    """SNK4: one spelling for column names (lower case; Spark matches names
    case-insensitively, so lower case loses nothing)."""
    return df.toDF(*[c.lower() for c in df.columns])


def read_csv_table(spark: SparkSession, path: str, table: str | None = None,
                   schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """SRC1: a CSV file (or folder of files) with a header row, typed by the
    registry schema of `table` (SRC2). `,,` and `,"",` both read as NULL.

    Columns are matched by header name, in any order and case; a header with
    other names fails, and so does a file of the folder whose header differs from
    the first one's. Quotes inside a field are doubled. A field may hold line
    ends, so a file is one task; `multi_line=False` splits large files that
    have none.
    """
    schema = schema or RAW_TABLES[table]
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    found = spark.read.options(**options).csv(path).columns
    wanted = {f.name.lower(): f for f in schema.fields}
    if sorted(c.lower() for c in found) != sorted(wanted):
        raise ValueError(f"{path}: the header has {found}, the table {list(wanted)}")
    in_file = T.StructType([T.StructField(c, wanted[c.lower()].dataType) for c in found])
    df = (spark.read.schema(in_file).options(**options)
          .option("enforceSchema", False)
          .option("mode", "FAILFAST")
          .csv(path))
    return normalise_columns(df).select(*wanted)


def read_raw_files(spark: SparkSession, path: str, table: str, fmt: str = "csv",
                   multi_line: bool = True) -> DataFrame:
    """A raw table from files: CSV with a header row (SRC1), or Parquet, both
    typed by the registry schema so no inference pass runs."""
    if fmt == "csv":
        return read_csv_table(spark, path, table, multi_line=multi_line)
    if fmt == "parquet":
        return normalise_columns(spark.read.schema(RAW_TABLES[table]).parquet(path))
    raise ValueError(f"unsupported format {fmt!r}: use 'csv' or 'parquet'")


def layer_schema(custom: str | None, default: str) -> str:
    """SNK7: the default schema when no custom name is given, otherwise the
    trimmed custom name, unprefixed."""
    return default if custom is None else custom.strip()


def ensure_schema(spark: SparkSession, name: str) -> str:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    return name


def write_view(df: DataFrame, name: str) -> DataFrame:
    """SNK5: a staging model is a view: lazy, recomputed by each reader."""
    df.createOrReplaceTempView(name)
    return df


def _swap(spark: SparkSession, schema: str, staged: str, name: str) -> None:
    """Give the table `staged` the name `name`; the table that had it goes only
    after that, and gets it back if the switch fails."""
    full, old = f"`{schema}`.`{name}`", f"`{schema}`.`{name}{_OLD}`"
    exists = spark.catalog.tableExists(full)
    if exists:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        spark.sql(f"ALTER TABLE {full} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE `{schema}`.`{staged}` RENAME TO {full}")
    except Exception:
        if exists:
            spark.sql(f"ALTER TABLE {old} RENAME TO {full}")
        raise
    if exists:
        spark.sql(f"DROP TABLE {old}")


def recover_table(spark: SparkSession, schema: str, name: str) -> bool:
    """Undo a switch that a lost driver left half done: the former table gets its
    name back if no table has it. Every write begins with this."""
    full, old = f"`{schema}`.`{name}`", f"`{schema}`.`{name}{_OLD}`"
    if spark.catalog.tableExists(full) or not spark.catalog.tableExists(old):
        return False
    spark.sql(f"ALTER TABLE {old} RENAME TO {full}")
    return True


def write_table(df: DataFrame, schema: str, name: str, mode: str = "overwrite",
                bucket_by: tuple[str, int] | None = None) -> int:
    """SNK2 / SNK6: materialise as a Parquet table `schema.name`; returns the
    number of rows this call wrote, counted by the write itself.

    An overwrite is written beside the table and takes its name when it is
    complete: until then, and after a write that fails, readers find the former
    rows (`df` may read them, too). The reference appends, so a re-run
    duplicates rows; `mode` defaults to overwrite and "append" keeps the
    reference's behaviour (`append_load` recognises a repeated one).
    `bucket_by=(key, n)` writes n buckets sorted by key, so later joins on key
    need no shuffle.
    """
    spark = df.sparkSession
    ensure_schema(spark, schema)
    recover_table(spark, schema, name)
    target = f"{name}_new_{uuid.uuid4().hex[:8]}" if mode == "overwrite" else name
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(
        "errorifexists" if mode == "overwrite" else mode).format("parquet")
    if bucket_by is not None:
        key, n = bucket_by
        writer = writer.bucketBy(n, key).sortBy(key)
    try:
        writer.saveAsTable(f"`{schema}`.`{target}`")
    except Exception:
        if mode == "overwrite":
            spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{target}`")
        raise
    if mode == "overwrite":
        _swap(spark, schema, target, name)
    return written.get["rows"]


_OLD = "_old"
LOG_SCHEMA = "load_id string, state string, rows_before long, rows_loaded long, at double"


def load_id(spark: SparkSession, path: str) -> str:
    """A file's (or a folder of files') identity: names, lengths and modification
    times. Files are listed by Spark; their content isn't read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select("path", "length", "modificationTime"))
    digest = F.xxhash64("path", "length", "modificationTime")
    r = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(digest).alias("x"),
                  F.sum(digest.cast("decimal(38,0)")).alias("s")).first()
    return f"{r.n}-{(r.x or 0) & (2 ** 64 - 1):016x}-{int(r.s or 0) & (2 ** 64 - 1):016x}"


def _rows(spark: SparkSession, schema: str, name: str) -> int:
    full = f"`{schema}`.`{name}`"
    return spark.table(full).count() if spark.catalog.tableExists(full) else 0


def _log_name(schema: str, table: str) -> str:
    return f"`{schema}`.`{table}_load_log`"


def _note(spark: SparkSession, schema: str, table: str, *row) -> None:
    """Add a commit row to the table's log of loads."""
    spark.createDataFrame([(*row, time.time())], LOG_SCHEMA).coalesce(1).write.mode("append").format(
        "parquet").saveAsTable(_log_name(schema, table))


def append_load(spark: SparkSession, path: str, table: str, schema: str = "raw",
                fmt: str = "csv", multi_line: bool = True, repeat: bool = False,
                bucket_by: tuple[str, int] | None = None) -> tuple[int, str]:
    """SNK2: append the files at `path` once; returns (rows, "loaded" or "repeated").

    Each append has a row in `<schema>.<table>_load_log`: "started" with the table's
    row count before the rows are written, "done" after. Files that an earlier
    append took (same names, lengths and times) add no rows unless `repeat` is
    set. After a job that was lost between the two rows, the table's count says
    whether its rows, which are committed together, arrived. An overwrite of the
    table starts the log anew. One writer per table at a time.
    """
    ensure_schema(spark, schema)
    recover_table(spark, schema, table)
    this, before = load_id(spark, path), _rows(spark, schema, table)
    if spark.catalog.tableExists(_log_name(schema, table)) and not repeat:
        log_rows = spark.table(_log_name(schema, table))
        since = log_rows.filter("state = 'overwritten'").agg(F.max("at")).first()[0] or 0.0
        past = log_rows.filter((F.col("load_id") == this) & (F.col("at") > since)).agg(
            F.max(F.col("state") == "done").alias("done"),
            F.max_by("rows_before", "at").alias("before")).first()
        if past.done:
            return 0, "repeated"
        if past.before is not None and before > past.before:
            _note(spark, schema, table, this, "done", past.before, before - past.before)
            return 0, "repeated"
    _note(spark, schema, table, this, "started", before, None)
    rows = write_table(read_raw_files(spark, path, table, fmt, multi_line), schema, table, "append", bucket_by)
    _note(spark, schema, table, this, "done", before, rows)
    return rows, "loaded"


def overwrite_load(spark: SparkSession, path: str, table: str, schema: str = "raw",
                   fmt: str = "csv", multi_line: bool = True,
                   bucket_by: tuple[str, int] | None = None) -> tuple[int, str]:
    """The table anew from the files at `path`; its log of appends starts anew, too."""
    rows = write_table(read_raw_files(spark, path, table, fmt, multi_line), schema, table, "overwrite", bucket_by)
    if spark.catalog.tableExists(_log_name(schema, table)):
        _note(spark, schema, table, None, "overwritten", None, rows)
    return rows, "loaded"


def load_waves() -> list[list[str]]:
    """The raw tables in waves: each after the tables it refers to."""
    depth: dict[str, int] = {}
    for table in LOAD_ORDER:
        depth[table] = 1 + max((depth[p] for p in PARENTS.get(table, [])), default=-1)
    return [[t for t in LOAD_ORDER if depth[t] == d] for d in range(max(depth.values()) + 1)]


def at_the_same_time(spark: SparkSession, run: Callable[[str], T_], names: list[str],
                     concurrent: int = 4) -> list[T_]:
    """run(name) of every name, up to `concurrent` jobs at the same time; the first
    failure is raised, when the jobs that had begun are over."""
    with ThreadPoolExecutor(max(1, concurrent)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(run), name) for name in names]
        try:
            return [job.result() for job in jobs]
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


def load_all(spark: SparkSession, in_dir: str, schema: str = "raw",
             mode: str = "overwrite", buckets: int | None = None,
             fmt: str = "csv", multi_line: bool = True, repeat: bool = False,
             concurrent: int = 4) -> DataFrame:
    """SNK3: load every registry table from `<in_dir>/<table>.<fmt>` (a file or
    a folder of files) in dependency order; returns a report of
    (table_name, rows_loaded, status, error). A table that fails leaves
    rows_loaded NULL and status "failed"; the others are loaded all the same.
    With mode "append", files that were appended before have status "repeated"
    and no rows, unless `repeat` is set.

    Tables that don't refer to each other load at the same time, up to
    `concurrent` jobs in the scheduler's fair pool `load` (where the cluster
    runs fair scheduling); children start after their parents.

    With `buckets`, the tables the library joins (JOIN_KEYS) are bucketed by
    their join key into that many buckets, co-locating both sides of the join.
    `multi_line=False` lets Spark split large CSV files that hold no line end
    inside a field.
    """
    def one(table: str) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "load")
        path = os.path.join(in_dir, f"{table}.{fmt}")
        bucket_by = (JOIN_KEYS[table], buckets) if buckets and table in JOIN_KEYS else None
        try:
            if mode == "append":
                rows, status = append_load(spark, path, table, schema, fmt, multi_line, repeat, bucket_by)
            else:
                rows, status = overwrite_load(spark, path, table, schema, fmt, multi_line, bucket_by)
        except (PySparkException, Py4JJavaError, ValueError) as exc:
            log.error("failed to load %s: %s", table, exc)
            return table, None, "failed", str(exc).splitlines()[0][:500]
        log.info("%s %d rows -> %s", status, rows, table)
        return table, rows, status, None

    ensure_schema(spark, schema)
    report: dict[str, tuple] = {}
    for wave in load_waves():
        for row in at_the_same_time(spark, one, wave, concurrent):
            report[row[0]] = row
    return spark.createDataFrame(
        [report[t] for t in LOAD_ORDER],
        "table_name string, rows_loaded long, status string, error string")


def raw_table(spark: SparkSession, name: str, schema: str = "raw") -> DataFrame:
    """SRC2: `source('raw', name)`."""
    if name not in RAW_TABLES:
        raise KeyError(f"unknown raw table {name!r}")
    return spark.table(f"`{schema}`.`{name}`")


def fetch_ab_test_data(spark: SparkSession, schema: str = "mart") -> DataFrame:
    """SRC4: the eight columns of the churn A/B mart."""
    return spark.table(f"`{schema}`.`{AB_MART}`").select(*AB_COLUMNS)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or,
    where that is unset, the warehouse. On a cluster a warehouse on the machine's
    own disk is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    base = named or spark.conf.get("spark.sql.warehouse.dir")
    own_disk = base.startswith("file:") or "://" not in base
    if not named and own_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/revops-scratch"


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)


def replace_folder(staged: str, path: str) -> None:
    """Put the folder `staged` in the place of `path`. What was there goes only when
    the new one has its place, and comes back if that fails."""
    fs, target = _filesystem(path)
    source = _filesystem(staged)[1]
    old = f"{target.rstrip('/')}.old-{uuid.uuid4().hex}"
    exists = fs.get_file_info(target).type != pyarrow.fs.FileType.NotFound
    if exists:
        fs.move(target, old)
    try:
        fs.move(source, target)
    except Exception:
        if exists:
            fs.move(old, target)
        raise
    if exists:
        is_file = fs.get_file_info(old).type == pyarrow.fs.FileType.File
        fs.delete_file(old) if is_file else fs.delete_dir(old)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """SNK1: write with a header row; quotes inside a field are doubled. An empty
    input leaves `path` as it was and warns.

    The input runs once: rows are counted by the write, which goes to a folder
    beside `path` and takes its place if there were any. Modes other than
    overwrite write to `path` itself.
    """
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}" if mode == "overwrite" else path
    written = Observation()
    (df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(mode)
     .option("header", True).option("escape", '"').csv(staged))
    rows = written.get["rows"]
    if not rows:
        log.warning("no rows generated for %s", path)
    if staged != path:
        if rows:
            replace_folder(staged, path)
        else:
            fs, folder = _filesystem(staged)
            fs.delete_dir(folder)
    return bool(rows)
