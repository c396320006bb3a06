"""The queries that SQL can express, against their DuckDB SQL."""

import duckdb
import pytest

from revops_spark.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in res.description]
    assert sorted(columns) == sorted(got.columns)
    kinds = {"long": "BIGINT", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}
    assert {c: kinds[t] for c, t in got.dtypes} == {c[0]: str(c[1]) for c in res.description}
    want = sorted(res.fetchall())
    assert want and sorted(tuple(r) for r in got.select(*columns).collect()) == want
