"""Events aligned to a time axis and divided into baseline, recent, in-recording and future parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.operators.asof import as_of
from bedside.operators.dedup import merge_events
from bedside.schemas import BASELINE_CAP_MS, CONTEXT_MS, FUTURE_CAP_MS, SEG_BASELINE, SEG_FUTURE, SEG_RECENT, SEGMENT_MS

SENTINELS = {"baseline": SEG_BASELINE, "recent": SEG_RECENT, "future": SEG_FUTURE}


def axis_bounds(axis: DataFrame, by: list[str]) -> DataFrame:
    return axis.groupBy(*by).agg(F.min("time_ms").alias("wave_start"), F.max("time_ms").alias("wave_last"), F.count("*").alias("n_seg"))


def split_events(events: DataFrame, axis: DataFrame, episodes: DataFrame | None = None, by: list[str] = ["entity_id"], context_ms: int = CONTEXT_MS, baseline_cap_ms: int = BASELINE_CAP_MS, future_cap_ms: int = FUTURE_CAP_MS, pad_ms: int = 0) -> DataFrame:  # noqa: B006
    """``events`` with part and seg_idx (M1); events outside all parts, or of entities without an axis, go.

    ``episodes``: ep_start and ep_end by entity, either may be null. The recent part
    isn't cut by the episode's start.
    """
    bounds = axis_bounds(axis, by)
    if episodes is not None:
        bounds = bounds.join(episodes.select(*by, "ep_start", "ep_end"), by, "left")
    else:
        bounds = bounds.withColumns({"ep_start": F.lit(None).cast("bigint"), "ep_end": F.lit(None).cast("bigint")})
    t, ws, we = F.col("time_ms"), F.col("wave_start"), F.col("wave_last") + pad_ms
    first = F.greatest(ws - baseline_cap_ms, F.col("ep_start"))
    last = F.least(we + future_cap_ms, F.col("ep_end"))
    part = (
        F.when((t >= ws) & (t <= we), "events")
        .when((t >= ws - context_ms) & (t < ws), "recent")
        .when((t >= first) & (t < ws - context_ms), "baseline")
        .when((t > we) & (t <= last), "future")
    )
    drop = [c for c in ("seg_idx", "part") if c in events.columns]
    parted = events.drop(*drop).join(bounds, by).withColumn("part", part).where("part IS NOT NULL")
    aligned = as_of(parted, axis.select(*by, "time_ms", "seg_idx"), by, "time_ms", ["seg_idx"])
    seg = F.col("seg_idx")
    for name, value in SENTINELS.items():
        seg = F.when(F.col("part") == name, value).otherwise(seg)
    return aligned.withColumn("seg_idx", seg.cast("int")).drop("wave_start", "wave_last", "n_seg", "ep_start", "ep_end")


def in_segment(events: DataFrame, axis: DataFrame, by: list[str], length_ms: int = SEGMENT_MS) -> DataFrame:
    """Whether an event lies inside its segment, not in the gap behind it."""
    at = axis.select(*by, "seg_idx", F.col("time_ms").alias("_seg_ms"))
    return events.join(at, [*by, "seg_idx"], "left").withColumn("in_segment", F.coalesce(F.col("time_ms") < F.col("_seg_ms") + length_ms, F.lit(False))).drop("_seg_ms")


def validate_parts(trajectory: DataFrame, axis: DataFrame, by: list[str] = ["entity_id"]) -> DataFrame:  # noqa: B006
    """Errors by entity and part (M2): sentinels, segment range."""
    sizes = axis.groupBy(*by).agg(F.count("*").alias("n_seg"))
    want = F.create_map(*(x for n, v in SENTINELS.items() for x in (F.lit(n), F.lit(v))))[F.col("part")]
    inside = F.col("part") == "events"
    found = trajectory.join(sizes, by, "left").groupBy(*by, "part").agg(
        F.count_if(inside & (F.col("seg_idx") < 0)).alias("n_negative"),
        F.count_if(inside & (F.col("seg_idx") >= F.coalesce("n_seg", F.lit(0)))).alias("n_beyond"),
        F.count_if(~inside & (F.col("seg_idx") != want)).alias("n_sentinel"),
    )
    texts = [F.when(F.col(c) > 0, F.concat(F.col("part"), F.lit(f": {what}"))) for c, what in (("n_negative", "negative seg_idx"), ("n_beyond", "seg_idx beyond the axis"), ("n_sentinel", "wrong sentinel"))]
    return found.withColumn("errors", F.array_compact(F.array(*texts)))


def part_summary(trajectory: DataFrame, by: list[str] = ["entity_id"], action_band: tuple[int, int] = (200, 299), score_band: tuple[int, int] = (300, 306), onset: int = 307) -> DataFrame:  # noqa: B006
    """Counts and distinct variables per part, and flags of what the future would leak (A10)."""
    part, var = F.col("part"), F.col("var_id")
    aggs = [F.count_if(part == p).alias(f"n_{p}") for p in ("baseline", "recent", "events", "future")]
    aggs += [F.count_distinct(F.when(part == p, var)).alias(f"vars_{p}") for p in ("events", "future")]
    leaks = {"actions": var.between(*action_band), "scores": var.between(*score_band), "onset": var == onset}
    aggs += [F.coalesce(F.bool_or((part == "future") & leak), F.lit(False)).alias(f"has_future_{name}") for name, leak in leaks.items()]
    return trajectory.groupBy(*by).agg(*aggs)


def add_events(trajectory: DataFrame, new_events: DataFrame, axis: DataFrame, episodes: DataFrame | None = None, by: list[str] = ["entity_id"], **bounds) -> DataFrame:  # noqa: B006
    """Late variables join a trajectory without touching signals (M6); doing it again changes nothing."""
    added = split_events(new_events, axis, episodes, by, **bounds)
    return merge_events(trajectory, added.select(*trajectory.columns), (*by, "time_ms", "var_id", "value"))


def last_values(trajectory: DataFrame, by: list[str], part: str = "recent") -> DataFrame:
    """Last value per variable."""
    return trajectory.where(F.col("part") == part).groupBy(*by, "var_id").agg(F.max_by("value", F.struct("time_ms", "value")).alias("last_value"), F.max("time_ms").alias("last_ms"))


def baseline_stats(trajectory: DataFrame, by: list[str], part: str = "baseline") -> DataFrame:
    """Mean, least and greatest value per variable."""
    return trajectory.where(F.col("part") == part).groupBy(*by, "var_id").agg(F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))


def whole_trajectory(trajectory: DataFrame, by: list[str]) -> DataFrame:
    """All parts in order of time within an entity."""
    return trajectory.repartition(*by).sortWithinPartitions(*by, "time_ms", "var_id")


def assert_no_leak(summary: DataFrame) -> DataFrame:
    """Fails when an entity's future holds actions."""
    return summary.withColumn("_ok", F.assert_true(~F.col("has_future_actions"), F.lit("the future part holds actions"))).where("_ok IS NULL").drop("_ok")


def leaking(summary: DataFrame) -> DataFrame:
    """Entities whose future holds what it must not, and what (M31); an empty table means there is no leak."""
    names = F.array_compact(F.array(*(F.when(F.col(f"has_future_{name}"), name) for name in ("actions", "scores", "onset"))))
    return summary.withColumn("leaks", names).where(F.size("leaks") > 0)
