"""Label-to-window samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside.functions.clean import label_clip
from bedside.functions.timebase import align
from bedside.operators.asof import as_of
from bedside.operators.dedup import first_per
from bedside.operators.segments import islands
from bedside.operators.throttling import kept_times
from bedside.schemas import SEGMENT_MS


def locate_windows(labels: DataFrame, axis: DataFrame, by: list[str], window_ms: int, alignment: str, segment_ms: int = SEGMENT_MS, stride_ms: int | None = None, tolerance_ms: int = 1) -> DataFrame:
    """``labels`` (time_ms) with t_start, t_end, seg_lo, seg_hi; nulls where a window doesn't fit or straddles a gap."""
    runs = islands(axis, by, "time_ms", stride_ms or segment_ms, tolerance_ms).select(*by, "time_ms", F.struct("seg_idx", F.col("time_ms").alias("at"), "island_id").alias("seg"))
    start, end = align(F.col("time_ms"), window_ms, alignment)
    spans = labels.withColumns({"t_start": start, "t_end": end})
    lo = as_of(spans, runs.withColumnRenamed("time_ms", "t_start"), by, "t_start", ["seg"]).withColumnRenamed("seg", "_lo")
    hi = as_of(lo, runs.withColumnRenamed("time_ms", "t_end"), by, "t_end", ["seg"], strict=True).withColumnRenamed("seg", "_hi")
    a, b = F.col("_lo"), F.col("_hi")
    ok = (a["seg_idx"] <= b["seg_idx"]) & (b["at"] + segment_ms >= F.col("t_end")) & (a["island_id"] == b["island_id"])
    return hi.withColumns({"seg_lo": F.when(ok, a["seg_idx"]), "seg_hi": F.when(ok, b["seg_idx"])}).drop("_lo", "_hi")


def throttle(labels: DataFrame, by: list[str], t: str, valid: Column, interval_ms: int, order: list[str], spread: list[str] = []) -> DataFrame:  # noqa: B006
    """Labels at least ``interval_ms`` after the last one that was kept and valid.

    Of labels at one time the first in ``order`` stays; rows that differ in ``spread`` are
    of one label. A null key is a key. What is kept depends on what was kept before; ``kept_times`` composes
    that over buckets of time, so a key may have any share of the labels.
    """
    once = first_per(labels.where(valid), [*by, t, *spread], order)
    chosen = kept_times(once.select(*by, t).distinct(), by, t, interval_ms)
    same = [once[c].eqNullSafe(chosen[c]) for c in (*by, t)]
    return once.join(chosen, same, "left_semi")


def sample_index(events: DataFrame, axis: DataFrame, by: list[str], targets: list[int], window_ms: int, alignment: str = "end", clip: tuple[float | None, float | None] = (None, None), offsets_ms: tuple[int, ...] = (0,), interval_ms: int = 0, segment_ms: int = SEGMENT_MS, label_transform=None) -> DataFrame:
    """One row per label and offset whose window is whole (M17): filter, offset, locate, throttle."""
    labels = events.where(F.col("var_id").isin(targets) & label_clip(F.col("value"), *clip)).select(*by, "var_id", F.col("time_ms").alias("label_ms"), "value")
    spread = labels.withColumn("offset_ms", F.explode(F.array(*(F.lit(o).cast("bigint") for o in offsets_ms)))).withColumn("time_ms", F.col("label_ms") + F.col("offset_ms"))
    found = locate_windows(spread, axis, by, window_ms, alignment, segment_ms).where("seg_lo IS NOT NULL")
    if interval_ms:
        found = throttle(found, [*by, "var_id"], "label_ms", F.lit(True), interval_ms, ["value"], ["offset_ms"])
    value = label_transform(F.col("value")) if label_transform else F.col("value")
    return found.select(*by, "var_id", "label_ms", "offset_ms", value.alias("value"), "t_start", "t_end", "seg_lo", "seg_hi")


def materialise(index: DataFrame, segments: DataFrame, by: list[str], waveform_transform=None) -> DataFrame:
    """Samples with their signals by channel (M18, G10); arrays are read only for what the index names.

    A window that reaches beyond its segments' samples is an error. Of a channel at several rates the highest is taken.
    """
    keys = [*by, "label_ms", "var_id", "offset_ms"]
    wanted = index.withColumn("seg_idx", F.explode(F.sequence("seg_lo", "seg_hi")))
    rows = wanted.join(segments.select(*by, "seg_idx", "channel", "fs", "samples", F.col("time_ms").alias("seg_ms")), [*by, "seg_idx"])
    joined = rows.groupBy(*keys, "channel", "fs").agg(F.first("t_start").alias("t_start"), F.first("t_end").alias("t_end"), F.min("seg_ms").alias("base"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("seg_idx", "samples"))), lambda s: s["samples"])).alias("block"))
    first = F.round((F.col("t_start") - F.col("base")) * F.col("fs") / 1000).cast("int")
    n = F.round((F.col("t_end") - F.col("t_start")) * F.col("fs") / 1000).cast("int")
    fits = F.assert_true((first >= 0) & (first + n <= F.size("block")), F.lit("a window reaches beyond its signal"))
    sliced = joined.withColumn("wave", F.when(fits.isNull(), F.slice("block", first + 1, n)))
    sliced = sliced.groupBy(*keys, "channel").agg(F.max_by("wave", "fs").alias("wave"))
    waves = sliced.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("channel", "wave"))).alias("waveforms"))
    out = index.join(waves, keys)
    return out.withColumn("waveforms", waveform_transform(F.col("waveforms"))) if waveform_transform else out


def with_channels(entities: DataFrame, required: list[str], channels: str = "channels") -> DataFrame:
    """Entities that have all required channels."""
    return entities.where(F.size(F.array_except(F.array(*map(F.lit, required)), F.col(channels))) == 0)


def concat_cohorts(indexes: dict[str, DataFrame]) -> DataFrame:
    """Samples of several cohorts with their names."""
    frames = [df.withColumn("dataset", F.lit(name)) for name, df in indexes.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def sample_stats(samples: DataFrame, by: list[str]) -> DataFrame:
    return samples.groupBy(*by).agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))


def ordered(df: DataFrame, by: list[str], t: str) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(t)))
