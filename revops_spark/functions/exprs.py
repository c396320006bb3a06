"""Scalar Column helpers shared by the marts (SC1-SC12).

All of them are built-in Spark expressions: they stay inside whole-stage
codegen and never leave the JVM. Helpers whose arguments are text (column
names or Spark SQL expressions: `round_ratio`, `pct`, `lookup`) build their
expression as SQL and hand it over in one `F.expr` call, rather than one JVM
round trip per operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_where(predicate: Column) -> Column:
    """`count(case when p then 1 end)`: rows where p is true; 0, never NULL (AGG2)."""
    return F.count(F.when(predicate, F.lit(1)))


def is_blank(c: ColumnOrName) -> Column:
    """NULL or the empty string (SC12)."""
    c = col(c)
    return c.isNull() | (c == F.lit(""))


def sql_arg(e: str | Column) -> str:
    """A column name or Spark SQL expression (text), parenthesised."""
    if not isinstance(e, str):
        raise TypeError("pass a column name or a Spark SQL expression as text")
    return f"({e})"


def round_ratio_sql(num: str, den: str, scale: int = 2, factor: int = 1) -> str:
    """`round(num * factor / nullif(den, 0), scale)` for integral num and den.

    Rounds the exact rational HALF_UP (away from zero), like decimal
    arithmetic with unlimited scale, so ties never depend on floating point or
    on an intermediate decimal scale. NULL when den is 0 or NULL (SC2, SC4).
    The integer quotient is taken as (x - x % y) / y in decimal(38,0): exact at
    any magnitude. The result is the double nearest the rounded decimal.
    """
    m = (10 ** scale) * factor
    n = f"CAST({sql_arg(num)} AS BIGINT)"
    dn = f"NULLIF(CAST({sql_arg(den)} AS BIGINT), 0)"
    x = f"(abs({n}) * {2 * m} + abs({dn}))"
    y = f"(abs({dn}) * 2)"
    q = f"CAST(CAST({x} - {x} % {y} AS DECIMAL(38,0)) / CAST({y} AS DECIMAL(38,0)) AS BIGINT)"
    signed = f"CASE WHEN ({n} < 0) <> ({dn} < 0) THEN -{q} ELSE {q} END"
    return f"(CAST({signed} AS DOUBLE) / {10 ** scale}.0D)"


def round_ratio(num: str, den: str, scale: int = 2, factor: int = 1) -> Column:
    return F.expr(round_ratio_sql(num, den, scale, factor))


def pct(num: str, den: str, scale: int = 2) -> Column:
    """`round(num * 100.0 / nullif(den, 0), scale)` on counts (SC3)."""
    return round_ratio(num, den, scale, factor=100)


def month_of(d: ColumnOrName) -> Column:
    """`date_trunc('month', d)` as a DATE (SC5)."""
    return F.trunc(col(d).cast("date"), "MM")


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """`datediff('day', start, end)` = end - start in calendar days (SC6)."""
    return F.date_diff(col(end).cast("date"), col(start).cast("date")).cast("bigint")


def sql_literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def lookup(key: str, mapping: dict) -> Column:
    """Keyed constant lookup on a column name or SQL expression; unknown keys
    give NULL (SC10). A predicate on the result doesn't reach the scan; where
    that matters, filter on `keys_of` the wanted values as well."""
    arms = " ".join(f"WHEN {sql_literal(k)} THEN {sql_literal(v)}" for k, v in mapping.items())
    return F.expr(f"CASE {sql_arg(key)} {arms} END" if arms else "NULL")


def keys_of(mapping: dict, values) -> list:
    """The keys a lookup maps to the given values: its inverse, for filters on
    the raw column that a scan can use."""
    return [k for k, v in mapping.items() if v in set(values)]


def money(c: ColumnOrName) -> Column:
    """Money as decimal(18,2): exact sums, no order-dependent float error."""
    return col(c).cast("decimal(18,2)")


def total_money(c: ColumnOrName) -> Column:
    """`sum(x)` of money, typed decimal(38,2) (AGG3)."""
    return F.sum(col(c)).cast("decimal(38,2)")
