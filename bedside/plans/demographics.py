"""One static row per entity from several tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.functions.clean import age


def demographics(entities: DataFrame, tables: list[tuple[DataFrame, list[str]]], birth: str | None = None, at: str | None = None, columns: dict[str, str] | None = None) -> DataFrame:
    """Left joins in order, with age and renamed columns. Each table has one row per key."""
    out = entities
    for table, on in tables:
        out = out.join(table, on, "left")
    if birth and at:
        out = out.withColumn("age", age(F.col(birth), F.col(at)))
    return out.select(*(F.col(source).alias(name) for name, source in columns.items())) if columns else out


def primary_diagnosis(diagnoses: DataFrame, key: str, seq: str = "seq_num") -> DataFrame:
    return diagnoses.where(F.col(seq) == 1).groupBy(key).agg(F.min("code").alias("primary_code"))
