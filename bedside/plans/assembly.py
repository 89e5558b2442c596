"""From raw events of several sources to a validated trajectory (M5); datasets differ by policy, not by code."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.functions.clean import finite, in_physio_range
from bedside.operators.dedup import first_per
from bedside.operators.mapping import map_codes
from bedside.operators.trajectory import part_summary, split_events, validate_parts


@dataclass(frozen=True)
class Policy:
    """What differs between datasets: range rule, deduplication, pad after the last segment."""

    physio_range: bool = True
    at_least: float | None = None
    dedup: bool = True
    pad_ms: int = 30_000


def clean_events(raw: DataFrame, registry: DataFrame, code: list[str], policy: Policy = Policy(), overrides: DataFrame | None = None) -> DataFrame:
    """Coded raw values to events: map, range, first per entity, time and variable.

    ``overrides`` (var_id, physio_min, physio_max) replaces ranges for one dataset (F6).
    """
    if overrides is not None:
        o = overrides.select("var_id", F.col("physio_min").alias("_lo"), F.col("physio_max").alias("_hi"))
        registry = registry.join(o, "var_id", "left").withColumns({"physio_min": F.coalesce("_lo", "physio_min"), "physio_max": F.coalesce("_hi", "physio_max")}).drop("_lo", "_hi")
    rows = map_codes(raw, registry, code).where(finite(F.col("value")))
    if policy.physio_range:
        rows = rows.where(in_physio_range(F.col("value"), F.col("physio_min"), F.col("physio_max")))
    if policy.at_least is not None:
        rows = rows.where(F.col("value") >= policy.at_least)
    if policy.dedup:
        rows = first_per(rows, ["entity_id", "time_ms", "var_id"], [*code, "value"])
    return rows.select("entity_id", "time_ms", "var_id", "value")


def assemble(sources: list[DataFrame], axis: DataFrame, episodes: DataFrame | None = None, policy: Policy = Policy(), by: list[str] = ["entity_id"]) -> tuple[DataFrame, DataFrame, DataFrame]:  # noqa: B006
    """Trajectory, its errors by part, and its summary by entity."""
    events = reduce(DataFrame.unionByName, sources)
    trajectory = split_events(events, axis, episodes, by, pad_ms=policy.pad_ms)
    return trajectory, validate_parts(trajectory, axis, by), part_summary(trajectory, by)


def not_yet_done(cohort: DataFrame, done: DataFrame, layout_version: int, key: str = "entity_id") -> DataFrame:
    """Entities without output of this layout."""
    return cohort.join(done.where(F.col("layout_version") == layout_version), key, "left_anti")
