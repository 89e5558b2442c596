"""Time axes, segments and array signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside.operators.buckets import WIDTH, deal, earlier, later, meet
from bedside.operators.overlay import overlaid, slices
from bedside.schemas import SEGMENT_MS

NAN = float("nan")


def number_segments(axis: DataFrame, by: list[str], t: str = "time_ms", width: float = WIDTH * SEGMENT_MS) -> DataFrame:
    """seg_idx from 0 in order of time (W1), counted within buckets of ``width`` and added up over them."""
    dealt, inside, over = deal(axis, by, t, width)
    rows = dealt.withColumn("_in", F.row_number().over(inside))
    buckets = rows.groupBy(*by, "_bucket").agg(F.max("_in").alias("_n"))
    met = meet(rows, buckets, by, {"_before": F.coalesce(F.sum("_n").over(earlier(over)), F.lit(0))})
    return met.withColumn("seg_idx", (F.col("_before") + F.col("_in") - 1).cast("int")).drop("_bucket", "_in", "_before")


def islands(axis: DataFrame, by: list[str], t: str = "time_ms", stride_ms: int = SEGMENT_MS, tolerance_ms: int = 1, width: float | None = None) -> DataFrame:
    """island_id: maximal runs whose steps are the stride within the tolerance."""

    def breaks(step: Column) -> Column:
        return F.abs(step - stride_ms) > tolerance_ms

    dealt, inside, over = deal(axis, by, t, width or WIDTH * stride_ms)
    new = F.when(breaks(F.col(t) - F.lag(t).over(inside)), 1).otherwise(0)
    rows = dealt.withColumn("_new", new).withColumn("_run", F.sum("_new").over(inside))
    buckets = rows.groupBy(*by, "_bucket").agg(F.min(t).alias("_first"), F.max(t).alias("_last"), F.sum("_new").alias("_n"))
    # Whether a bucket's first row begins a run is settled by the bucket before.
    step = F.col("_first") - F.lag("_last").over(over)
    opened = buckets.withColumn("_opens", F.when(step.isNull() | breaks(step), 1).otherwise(0))
    base = F.sum(F.col("_opens") + F.col("_n")).over(over) - F.col("_n")
    met = meet(rows, opened, by, {"_base": base})
    return met.withColumn("island_id", F.col("_base") + F.col("_run") - 1).drop("_bucket", "_new", "_run", "_base")


def axis_report(axis: DataFrame, by: list[str], t: str = "time_ms", stride_ms: int = SEGMENT_MS, width: int = WIDTH) -> DataFrame:
    """Segments, bounds, whether times increase in the order of seg_idx, and gaps."""
    dealt, inside, over = deal(axis, by, "seg_idx", width)
    rows = dealt.withColumn("_step", F.col(t) - F.lag(t).over(inside))
    falls, gaps = F.count_if(F.col("_step") <= 0), F.count_if(F.col("_step") > 1.5 * stride_ms)
    ends = [F.min_by(t, "seg_idx").alias("_first"), F.max_by(t, "seg_idx").alias("_last"), F.min(t).alias("_low"), F.max(t).alias("_high")]
    buckets = rows.groupBy(*by, "_bucket").agg(*ends, F.count("*").alias("_n"), falls.alias("_falls"), gaps.alias("_gaps"))
    stepped = buckets.withColumn("_step", F.col("_first") - F.lag("_last").over(over))
    increasing = (F.sum("_falls") + falls) == 0
    return stepped.groupBy(*by).agg(F.sum("_n").alias("n_seg"), F.min("_low").alias("wave_start"), F.max("_high").alias("wave_end"), increasing.alias("increasing"), (F.sum("_gaps") + gaps).alias("n_gaps"))


def anchor_blocks(chunks: DataFrame, by: list[str], order: str, broken: Column, width: float = WIDTH) -> DataFrame:
    """block_id of maximal runs of usable rows (W4): a broken row belongs to none. ``order`` is a number."""
    marked = chunks.withColumn("_broken", F.coalesce(broken, F.lit(True)).cast("int"))
    dealt, inside, over = deal(marked, by, order, width)
    start = F.when((F.col("_broken") == 0) & (F.lag("_broken").over(inside) == 1), 1).otherwise(0)
    rows = dealt.withColumn("_start", start).withColumn("_run", F.sum("_start").over(inside))
    buckets = rows.groupBy(*by, "_bucket").agg(F.min_by("_broken", order).alias("_first"), F.max_by("_broken", order).alias("_last"), F.sum("_start").alias("_n"))
    opens = F.when((F.col("_first") == 0) & (F.coalesce(F.lag("_last").over(over), F.lit(1)) == 1), 1).otherwise(0)
    base = F.sum(F.col("_opens") + F.col("_n")).over(over) - F.col("_n")
    met = meet(rows, buckets.withColumn("_opens", opens), by, {"_base": base})
    return met.withColumn("block_id", F.col("_base") + F.col("_run") - 1).where("_broken = 0").drop("_bucket", "_broken", "_start", "_run", "_base")


def cut(blocks: DataFrame, samples: str, window: int, stride: int) -> DataFrame:
    """Windows of ``window`` samples every ``stride`` (G2; G3 with equal numbers); short blocks give none."""
    starts = F.when(F.size(samples) >= window, F.sequence(F.lit(0), F.size(samples) - window, F.lit(stride)))
    rest = [c for c in blocks.columns if c != samples]
    return blocks.select(*rest, samples, F.posexplode(starts).alias("place", "first")).select(*rest, "place", "first", F.slice(samples, F.col("first") + 1, window).alias("segment"))


def nan_fraction(samples: Column) -> Column:
    return F.size(F.filter(samples, lambda x: x.isNull() | F.isnan(x))) / F.size(samples)


def or_missing(samples: Column, n: int) -> Column:
    """A channel that is not there is a segment of NaN."""
    return F.coalesce(samples, F.array_repeat(F.lit(NAN).cast("float"), n))


def nan_gate(samples: Column, most: float) -> Column:
    """Whether an anchor segment has few enough NaN."""
    return nan_fraction(samples) <= most


def assemble_seconds(
    seconds: DataFrame,
    by: list[str],
    second: str,
    samples: str,
    fs: int,
    length_s: int = 30,
    order: str | None = None,
    first_second: str | None = None,
) -> DataFrame:
    """Windows of ``length_s`` seconds from one-second blocks, with the number of seconds present.

    A block of another length than ``fs`` or with half or more NaN counts as absent; absent seconds are NaN. Of several blocks of
    a second the last in ``order`` counts, whether or not it is usable; without an order the greatest one.
    Windows begin at multiples of their length, or at ``first_second``.
    """
    from_first = F.col(second) - (F.col(first_second) if first_second else F.lit(0))
    place = F.struct(F.floor(from_first / length_s).alias("window"), F.pmod(from_first, F.lit(length_s)).cast("int").alias("at"))
    last = F.max(F.struct(F.col(order or samples).alias("order"), F.col(samples).alias("x")))
    once = seconds.withColumn("_place", place).groupBy(*by, "_place").agg(last["x"].alias("_x"))
    usable = once.where((F.size("_x") == fs) & (nan_fraction(F.col("_x")) < 0.5))
    pairs = F.collect_list(F.struct(F.col("_place.at"), F.col("_x")))
    got = usable.groupBy(*by, F.col("_place.window").alias("window")).agg(F.map_from_entries(pairs).alias("_have"))
    blank = F.array_repeat(F.lit(NAN).cast("float"), fs)
    filled = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(length_s - 1)), lambda s: F.coalesce(F.element_at("_have", s), blank)))
    return got.select(*by, "window", F.size("_have").alias("coverage_s"), filled.alias("samples"))


def clean_entities(windows: DataFrame, by: list[str], length_s: int = 30, least: int = 5) -> DataFrame:
    """Entities with enough fully covered windows."""
    return windows.groupBy(*by).agg(F.count_if(F.col("coverage_s") == length_s).alias("n_clean")).where(F.col("n_clean") >= least)


def place_on_grid(
    chunks: DataFrame,
    by: list[str],
    start: str,
    samples: str,
    order: str,
    episode_start: str,
    episode_end: str,
    step_ms: int,
    per_segment: int,
) -> DataFrame:
    """Samples on a fixed grid from the episode's start (G9): later chunks overwrite, samples outside are dropped."""
    first = F.floor((F.col(start) - F.col(episode_start)) / step_ms)
    inside = F.ceil((F.col(episode_end) - F.col(start)) / step_ms)  # samples before the episode's end
    high = first + F.least(F.size(samples), inside)
    cut = slices(chunks, [*by, order], first, F.greatest(first, F.lit(0)), high, samples, per_segment)
    return overlaid(cut, by, order, per_segment)


def channel_quality(segments: DataFrame, by: list[str], samples: str = "samples") -> DataFrame:
    """NaN ratio of the samples and share of segments with any valid sample, per channel."""
    nan = F.size(F.filter(samples, lambda x: F.isnan(x)))
    return segments.groupBy(*by).agg((F.sum(nan) / F.sum(F.size(samples))).alias("nan_ratio"), F.avg((nan < F.size(samples)).cast("double")).alias("valid_ratio"), F.count("*").alias("n_seg"))


def rate_errors(segments: DataFrame) -> DataFrame:
    """Segments whose length isn't fs times 30 seconds."""
    return segments.where(F.size("samples") != F.col("fs") * 30)


def to_events(numerics: DataFrame, keys: list[str], samples: str, start: str, step_ms: int) -> DataFrame:
    """Dense numbers to sparse events: one row per number that is there."""
    rows = numerics.select(*keys, F.col(start).alias("_s"), F.posexplode(samples).alias("_i", "value"))
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value")).select(*keys, (F.col("_s") + F.col("_i") * step_ms).alias("time_ms"), "value")


def envelope(segments: DataFrame, step: int, samples: str = "samples") -> DataFrame:
    """Mean, deviation and NaN share of every ``step``-th segment."""
    good = F.filter(samples, lambda x: ~F.isnan(x))
    n = F.size(good)
    zero = F.lit(0.0)
    mean = F.aggregate(good, zero, lambda a, x: a + x) / n
    picked = segments.where(F.col("seg_idx") % step == 0).withColumn("_mean", F.when(n > 0, mean))
    var = F.aggregate(good, zero, lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean"))) / n
    return picked.select(*(c for c in segments.columns if c != samples), F.col("_mean").alias("mean"), F.when(n > 0, F.sqrt(var)).alias("std"), nan_fraction(F.col(samples)).alias("nan_ratio"))


def sliding_index(counts: DataFrame, by: list[str], n: str, k: int, stride: int) -> DataFrame:
    """First rows 0, stride, ... up to n - k."""
    return counts.where(F.col(n) >= k).select(*by, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - k, F.lit(stride).cast("bigint"))).alias("first"))


def events_in_segments(events: DataFrame, low: int, high: int) -> DataFrame:
    return events.where((F.col("seg_idx") >= low) & (F.col("seg_idx") < high))  # W12


def step_changes(values: DataFrame, by: list[str], t: str, value: str, least: float = 0.5, width: float = WIDTH * SEGMENT_MS) -> DataFrame:
    """Rows where a held value moves by more than ``least``, the first row included (W6); missing values are skipped."""
    dealt, inside, over = deal(values.where(F.col(value).isNotNull() & ~F.isnan(value)), by, t, width)
    rows = dealt.withColumns({"_lag": F.lag(value).over(inside), "_in": F.row_number().over(inside)})
    buckets = rows.groupBy(*by, "_bucket").agg(F.max_by(value, "_in").alias("_last"))
    met = meet(rows, buckets, by, {"_carry": F.lag("_last").over(over)})
    before = F.coalesce("_lag", "_carry")
    return met.where(before.isNull() | (F.abs(F.col(value) - before) > least)).drop("_bucket", "_lag", "_in", "_carry")


def dense_grid(axis: DataFrame, events: DataFrame, by: list[str], variables: list[int], width: int = WIDTH) -> DataFrame:
    """Per segment and variable the last measurement (mask 2), an interpolation between two (mask 1), or nothing (mask 0)."""
    measured = events.groupBy(*by, "seg_idx", "var_id").agg(F.max_by("value", "time_ms").alias("measured"))
    cells = axis.select(*by, "seg_idx").withColumn("var_id", F.explode(F.array(*(F.lit(v) for v in variables))))
    grid = cells.join(measured, [*by, "seg_idx", "var_id"], "left")
    point = F.when(F.col("measured").isNotNull(), F.struct("seg_idx", "measured"))
    dealt, inside, over = deal(grid, [*by, "var_id"], "seg_idx", width)
    onward = inside.rowsBetween(0, Window.unboundedFollowing)
    rows = dealt.withColumns({"_a": F.last(point, ignorenulls=True).over(inside), "_b": F.first(point, ignorenulls=True).over(onward)})
    # The nearest measurements of other buckets; a bucket without any has none to give.
    buckets = rows.groupBy(*by, "var_id", "_bucket").agg(F.min("_b").alias("_first"), F.max("_a").alias("_last"))
    last = F.last("_last", ignorenulls=True).over(earlier(over))
    following = F.first("_first", ignorenulls=True).over(later(over))
    met = meet(rows, buckets, [*by, "var_id"], {"_from": last, "_to": following})
    a, b = F.coalesce("_a", "_from"), F.coalesce("_b", "_to")
    line = a["measured"] + (b["measured"] - a["measured"]) * (F.col("seg_idx") - a["seg_idx"]) / (b["seg_idx"] - a["seg_idx"])
    between = a.isNotNull() & b.isNotNull()
    mask = F.when(F.col("measured").isNotNull(), 2).when(between, 1).otherwise(0)
    return met.select(*by, "seg_idx", "var_id", mask.alias("mask"), F.when(F.col("measured").isNotNull(), F.col("measured")).when(between, line).alias("value"))
