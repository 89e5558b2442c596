"""Events of a stream against a stored axis: a stream-static join, as the part rule needs no state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.operators.trajectory import axis_bounds
from bedside.schemas import BASELINE_CAP_MS, CONTEXT_MS, FUTURE_CAP_MS, SEG_BASELINE, SEG_FUTURE, SEG_RECENT


def split_stream(events: DataFrame, axis: DataFrame, by: list[str], pad_ms: int = 0) -> DataFrame:
    """part of streaming events, with the sentinel seg_idx outside the recording; inside it seg_idx is left to the batch as-of join."""
    bounds = axis_bounds(axis, by)
    t, ws, we = F.col("time_ms"), F.col("wave_start"), F.col("wave_last") + pad_ms
    part = (
        F.when((t >= ws) & (t <= we), "events")
        .when((t >= ws - CONTEXT_MS) & (t < ws), "recent")
        .when((t >= ws - BASELINE_CAP_MS) & (t < ws - CONTEXT_MS), "baseline")
        .when((t > we) & (t <= we + FUTURE_CAP_MS), "future")
    )
    sentinel = F.when(F.col("part") == "baseline", SEG_BASELINE).when(F.col("part") == "recent", SEG_RECENT).when(F.col("part") == "future", SEG_FUTURE)
    return events.join(bounds, by).withColumn("part", part).where("part IS NOT NULL").withColumn("seg_idx", sentinel).drop("wave_start", "wave_last", "n_seg")
