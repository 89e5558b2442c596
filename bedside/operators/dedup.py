"""Deduplication rules; each states its order where the first row wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row per key in ``order``."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", number).where("_place = 1").drop("_place")


def merge_events(existing: DataFrame, incoming: DataFrame, keys: tuple[str, ...] = ("entity_id", "time_ms", "var_id", "value")) -> DataFrame:
    """Union without repeats of the same measurement (U2); merging again changes nothing."""
    return existing.unionByName(incoming).dropDuplicates(list(keys))


def replace_band(existing: DataFrame, incoming: DataFrame, low: int, high: int) -> DataFrame:
    """Replace all events of a band of variables."""
    return existing.where(~F.col("var_id").between(low, high)).unionByName(incoming.where(F.col("var_id").between(low, high)))
