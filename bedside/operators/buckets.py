"""Ordered work over an entity's rows, cut into buckets of the order.

An entity may hold a third of all rows, so nothing here sorts a whole entity in one
task: rows are windowed by entity and bucket, and what a bucket needs from the others
comes from a table with one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of a regular axis that share a bucket.
WIDTH = 4096


def deal(rows: DataFrame, by: list[str], order: str, width: float) -> tuple[DataFrame, WindowSpec, WindowSpec]:
    """``rows`` with ``_bucket``, the window within a bucket, and the one over the table of an entity's buckets."""
    dealt = rows.withColumn("_bucket", F.floor(F.col(order) / width))
    return dealt, Window.partitionBy(*by, "_bucket").orderBy(order), Window.partitionBy(*by).orderBy("_bucket")


def earlier(over: WindowSpec) -> WindowSpec:
    return over.rowsBetween(Window.unboundedPreceding, -1)


def later(over: WindowSpec) -> WindowSpec:
    return over.rowsBetween(1, Window.unboundedFollowing)


def meet(rows: DataFrame, buckets: DataFrame, by: list[str], carried: dict[str, Column]) -> DataFrame:
    """``rows`` with ``carried``, columns over the table of ``buckets``; null keys meet null keys."""
    keys = [*by, "_bucket"]
    table = buckets.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), *(c.alias(n) for n, c in carried.items()))
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return rows.join(table, same, "left").drop(*(f"_key{i}" for i in range(len(keys))))
