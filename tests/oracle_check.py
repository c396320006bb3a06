"""Spark result vs DuckDB oracle: row count, column names and types, value multiset."""

from __future__ import annotations

import collections
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# exact type pairs: Spark type -> DuckDB type name
_FAMILY = {
    "StringType": "VARCHAR", "VARCHAR": "VARCHAR",
    "LongType": "BIGINT", "BIGINT": "BIGINT", "IntegerType": "INTEGER", "INTEGER": "INTEGER",
    "DoubleType": "DOUBLE", "DOUBLE": "DOUBLE",
    "BooleanType": "BOOLEAN", "BOOLEAN": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    return v


def compare(spark_df, con, sql: str) -> list[str]:
    """Return a list of differences (empty when equal)."""
    problems = []
    s_cols = spark_df.columns
    s_types = {f.name: _FAMILY.get(type(f.dataType).__name__, type(f.dataType).__name__)
               for f in spark_df.schema.fields}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_types = {c[0]: _FAMILY.get(str(c[1]), str(c[1])) for c in res.description}
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return [f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"]
    for c in s_cols:
        if s_types[c] != d_types[c]:
            problems.append(f"type of {c}: spark={s_types[c]} oracle={d_types[c]}")
    order = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in order]
    d_idx = [d_cols.index(c) for c in order]
    s_rows = spark_df.collect()
    s_bag = collections.Counter(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    d_bag = collections.Counter(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} oracle={len(d_rows)}")
    if s_bag != d_bag:
        only_s = list((s_bag - d_bag).elements())[:3]
        only_d = list((d_bag - s_bag).elements())[:3]
        problems.append(f"values differ ({order}); spark only {only_s}; oracle only {only_d}")
    return problems
