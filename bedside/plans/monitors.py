"""From blocks of monitor files to windows of signals: scaling, seconds, windows from the first block on, resampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.functions.clean import valid_samples
from bedside.operators.resample import resample
from bedside.operators.segments import NAN, assemble_seconds, clean_entities

#: Raw samples at or beyond these stand for none.
SENTINELS = (-32767, 32767)


def scaled_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks whose number of samples is the stated one, with NaN for what is no sample or out of range."""
    good = blocks.where("gain IS NOT NULL AND offset IS NOT NULL AND points > 0 AND size(samples) = points")
    x = valid_samples(F.col("samples"), F.col("min"), F.col("max"), F.col("gain"), F.col("offset"), SENTINELS)
    return good.withColumn("samples", x)


def resample_window(x: np.ndarray, source: int, target: int) -> np.ndarray:
    """A window of whole seconds at another rate; missing samples count as 0, and seconds without any stay missing."""
    absent = np.isnan(x).reshape(-1, source).all(axis=1)
    out = resample(np.nan_to_num(x, nan=0.0), source, target)[: len(absent) * target]
    out[np.repeat(absent, target)] = np.nan
    return out


def resampled_windows(windows: DataFrame, source: int, target: int) -> DataFrame:
    if source == target:
        return windows
    names = windows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [resample_window(x.values.to_numpy(zero_copy_only=False).astype(float), source, target).astype(np.float32) for x in batch["samples"]]
            made = pa.array(out, pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([made if n == "samples" else batch[n] for n in names], names=names)

    return windows.mapInArrow(run, windows.schema)


def monitor_windows(
    blocks: DataFrame,
    anchor: str,
    rates: dict[str, tuple[int, int]],
    length_s: int = 30,
    least_seconds: int = 1,
    least_clean: int = 5,
) -> DataFrame:
    """entity_id, time_ms, and coverage and samples of each channel in windows of ``length_s`` seconds.

    ``blocks``: entity_id, block_ms, file and the columns of ``monitor_blocks``, one second each.
    ``rates`` gives the rate of each channel and the one it is brought to. Windows begin at the first second of ``anchor``
    and end with its last one; those with fewer than ``least_seconds`` of it go, and entities with fewer than
    ``least_clean`` windows that it fills. Of repeated seconds the one of the last file counts; blocks between
    whole seconds from the first don't. A channel that isn't there is NaN. Where the rate stays, samples stay as they are.
    """
    good = scaled_blocks(blocks.where(F.col("channel").isin(*rates)))
    ends = good.where(F.col("channel") == anchor).groupBy("entity_id").agg(F.min("block_ms").alias("first_ms"), F.max("block_ms").alias("last_ms"))
    timed = good.join(ends, "entity_id").withColumn("_ms", F.col("block_ms") - F.col("first_ms"))
    windows_ms = length_s * 1000
    within = F.floor(F.col("_ms") / windows_ms).between(0, F.floor((F.col("last_ms") - F.col("first_ms")) / windows_ms))
    seconds = timed.where(within & (F.col("_ms") % 1000 == 0)).withColumn("second", F.floor(F.col("_ms") / 1000))
    by = ["entity_id", "first_ms"]

    def of(channel: str) -> DataFrame:
        own = seconds.where(F.col("channel") == channel)
        return assemble_seconds(own, by, "second", "samples", rates[channel][0], length_s, order="file")

    kept = of(anchor).where(F.col("coverage_s") >= least_seconds)
    kept = kept.join(clean_entities(kept, ["entity_id"], length_s, least_clean).select("entity_id"), "entity_id", "left_semi")
    out = kept.select(*by, "window")
    for channel, (source, target) in rates.items():
        made = resampled_windows(kept if channel == anchor else of(channel), source, target)
        made = made.withColumnsRenamed({"coverage_s": f"coverage_{channel}", "samples": channel})
        out = out.join(made, [*by, "window"], "left")
    none = {c: F.coalesce(c, F.array_repeat(F.lit(NAN).cast("float"), length_s * target)) for c, (_, target) in rates.items()}
    covered = {f"coverage_{c}": F.coalesce(f"coverage_{c}", F.lit(0)) for c in rates}
    out = out.withColumns(none | covered).withColumn("time_ms", F.col("first_ms") + F.col("window") * windows_ms)
    return out.select("entity_id", "time_ms", *(n for c in rates for n in (f"coverage_{c}", c)))
