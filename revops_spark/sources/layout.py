"""Order layout: orders and their line items bucketed alike by order.

Every query about opportunities rolls line items up per order and joins them to
the orders. Stored once in buckets of the order key, sorted within them, both
sides are where the aggregate and the join need them: neither is shuffled again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .files import write_table
from .testdata import line_rollup, table

ORDER_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


@dataclass(frozen=True)
class OrderLayout:
    """Stands for a folder of test tables of which some are catalogue tables; takes
    the folder's place in every adapter and query."""

    folder: str
    schema: str

    def __str__(self) -> str:
        return self.folder

    def stored(self, spark: SparkSession, name: str) -> DataFrame | None:
        return spark.table(f"`{self.schema}`.`{name}`") if name in ORDER_KEYS else None


def write_order_layout(spark: SparkSession, folder: str, schema: str, buckets: int) -> OrderLayout:
    """Write both tables into `buckets` buckets; choose so many that a bucket of line
    items fits a task's memory (about 200 MB)."""
    for name, key in ORDER_KEYS.items():
        write_table(table(spark, folder, name).repartition(buckets, key), schema, name, bucket_by=(key, buckets))
    return OrderLayout(folder, schema)


@dataclass(frozen=True)
class RolledUp:
    """Stands for a folder of test tables whose line items' roll-up is stored at
    `path`, so that several adapters read it instead of computing it again. One
    that needs a column left out of the store fails when it is planned."""

    folder: str
    path: str

    def __str__(self) -> str:
        return self.folder

    def rolled_up(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def store_rollup(spark: SparkSession, folder: str, path: str, columns: list[str] | None = None) -> RolledUp:
    """Store the roll-up, or its key and `columns`: the others are neither computed
    nor read from the line items."""
    rolled = line_rollup(spark, folder)
    if columns is not None:
        rolled = rolled.select(ORDER_KEYS["orders"], *columns)
    rolled.write.parquet(path)
    return RolledUp(str(folder), path)
