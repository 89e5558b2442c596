"""The variable registry and lists of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per variable from a JSON document with an array ``variables``."""
    return spark.read.option("multiLine", True).json(path).select(F.inline("variables")).withColumnRenamed("id", "var_id")


def source_codes(registry: DataFrame, column: str) -> DataFrame:
    """code, var_id and range for one source's code list."""
    return registry.select(F.explode(F.col(column).cast("array<string>")).alias("code"), "var_id", "physio_min", "physio_max")


def resolve_entities(axis: DataFrame, explicit: DataFrame | None = None, splits: DataFrame | None = None, split: str | None = None, key: str = "entity_id") -> DataFrame:
    """An explicit list, else a split's entities, else all that have a time axis."""
    if explicit is not None:
        return explicit.select(key).distinct()
    if splits is not None:
        return splits.where(F.col("split") == split).select(key).distinct()
    return axis.select(key).distinct()


def read_id_list(spark: SparkSession, path: str, key: str = "entity_id") -> DataFrame:
    """One id per line, a header tolerated."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias(key)).where(F.col(key).isNotNull())


def labelled_patients(df: DataFrame, reward: str = "mortality_reward") -> DataFrame:
    return df.withColumn("died", F.col(reward).try_cast("double") < 0)  # S16
