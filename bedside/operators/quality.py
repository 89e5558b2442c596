"""Validation of entities and tables as aggregates; a check is a name, a severity and a condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside.operators.segments import axis_report


def manifest(axis: DataFrame, segments: DataFrame, trajectory: DataFrame, by: list[str], channels: list[str], pad_ms: int = 0) -> DataFrame:
    """One row per entity of the axis: counts, bounds, channels, errors, valid (M3)."""
    times = axis_report(axis, by)
    signal = segments.groupBy(*by).agg(F.count_distinct("channel").alias("n_channels"), F.count_if(F.size("samples") != F.col("fs") * 30).alias("n_bad_width"), F.count_distinct("seg_idx").alias("n_signal_seg"), F.sort_array(F.collect_set("channel")).alias("channels"))
    bounds = trajectory.groupBy(*by).agg(F.count("*").alias("n_events"), F.count_if(F.col("part") == "events").alias("n_in_wave"), F.min(F.when(F.col("part") == "events", F.col("time_ms"))).alias("first_in_wave"), F.max(F.when(F.col("part") == "events", F.col("time_ms"))).alias("last_in_wave"))
    all_of = times.join(signal, by, "left").join(bounds, by, "left")
    checks: list[tuple[str, Column]] = [
        ("times do not increase", ~F.col("increasing")),
        ("missing channel", F.size(F.array_except(F.array(*map(F.lit, channels)), F.coalesce("channels", F.array().cast("array<string>")))) > 0),
        ("wrong segment length", F.coalesce("n_bad_width", F.lit(0)) > 0),
        ("segments and axis differ", F.coalesce("n_signal_seg", F.lit(0)) != F.col("n_seg")),
        ("event before the recording", F.col("first_in_wave") < F.col("wave_start")),
        ("event after the recording", F.col("last_in_wave") > F.col("wave_end") + pad_ms),
    ]
    errors = F.array_compact(F.array(*(F.when(c, name) for name, c in checks)))
    return all_of.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)


def counts_of(checks: list[tuple[str, str, Column]]) -> list[Column]:
    """What fails each check, as counts named by its place; a null condition doesn't fail."""
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(f"bad_{i}") for i, (_, _, c) in enumerate(checks)]


def failures(checks: list[tuple[str, str, Column]], counts: dict[str, int]) -> list[tuple[str, str, int, bool]]:
    """(check, severity, n_bad, passed) from counts by place."""
    return [(n, s, counts[f"bad_{i}"], counts[f"bad_{i}"] == 0) for i, (n, s, _) in enumerate(checks)]


def report(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Rows that fail each (name, severity, condition), counted in one pass (M4)."""
    counts = df.agg(F.array(*(F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.count_if(F.coalesce(c, F.lit(False))).alias("n_bad")) for n, s, c in checks)).alias("c"))
    return counts.select(F.inline("c")).withColumn("passed", F.col("n_bad") == 0)


def in_two_parts(trajectory: DataFrame, by: list[str]) -> DataFrame:
    """Events that stand in more than one part: there must be none."""
    return trajectory.groupBy(*by, "time_ms", "var_id", "value").agg(F.count_distinct("part").alias("n_parts")).where("n_parts > 1")


def split_overlap(splits: DataFrame, patient: str) -> DataFrame:
    """Patients in more than one split: there must be none."""
    return splits.groupBy(patient).agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")
