"""Task cohorts from event counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.operators.mapping import registry_side


@dataclass(frozen=True)
class TaskSpec:
    task_name: str
    target_var_ids: tuple[int, ...]
    min_events_per_target: int = 1
    eligibility: str = "any"


def resolve_targets(registry: DataFrame, targets: list[int | str]) -> list[int]:
    """Variables by number or by name in any case (S8); an unknown one raises."""
    names = [t.lower() for t in targets if isinstance(t, str)]
    ids = [t for t in targets if isinstance(t, int)]
    rows = registry.where(F.lower("name").isin(names) | F.col("var_id").isin(ids)).select("var_id", F.lower("name").alias("name")).collect()
    by_name, known = {r["name"]: r["var_id"] for r in rows}, {r["var_id"] for r in rows}
    missing = [n for n in names if n not in by_name] + [i for i in ids if i not in known]
    if missing:
        raise KeyError(f"unknown variables: {missing}")
    return [by_name[t.lower()] if isinstance(t, str) else t for t in targets]


def build_task(counts: DataFrame, entities: DataFrame, spec: TaskSpec, by: list[str]) -> DataFrame:
    """Eligible entities (M16): any or all targets with enough events; per_target gives one cohort per variable.

    An entity without events of a target has 0 of them, which is enough where 0 are asked for.
    """
    inside = counts.where((F.col("part") == "events") & F.col("var_id").isin(*spec.target_var_ids)).select(*by, "var_id", "n")
    cells = entities.select(*by).withColumn("var_id", F.explode(F.array(*(F.lit(v) for v in spec.target_var_ids))))
    met = cells.join(inside, [*by, "var_id"], "left").where(F.coalesce("n", F.lit(0)) >= spec.min_events_per_target)
    if spec.eligibility == "per_target":
        return met.select(*by, "var_id")
    least = len(spec.target_var_ids) if spec.eligibility == "all" else 1
    return met.groupBy(*by).count().where(F.col("count") >= least).select(*by)


def downstream_rows(splits: DataFrame, sizes: DataFrame, by: str, patient: str, root: str) -> DataFrame:
    """Rows of a split list (K6): directory, patient, first segment, number of segments, no onset (-1), control (0)."""
    place = F.concat_ws("/", F.lit(root), F.col(by)).alias("dir")
    n = F.coalesce("n_seg", F.lit(0)).cast("int").alias("n_seg")
    rest = [F.lit(0).alias("first"), n, F.lit(-1).alias("onset"), F.lit(0).alias("label")]
    return splits.join(sizes.select(by, "n_seg"), by, "left").select("split", place, F.col(patient).cast("string").alias("patient"), *rest)


def named(counts: DataFrame, registry: DataFrame) -> DataFrame:
    return counts.join(registry_side(registry), "var_id", "left")
