"""Range and interval joins as equi-joins on dyadic nodes or time buckets, so that no key's rows meet all in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside.operators.intervals import ancestors, cell, covered, levels_of, meet_points


def points_in_intervals(
    points: DataFrame, intervals: DataFrame, by: list[str], t: str, start: str, end: str, unit: int, buffer: int = 0
) -> DataFrame:
    """Pairs of a point and an interval that holds it, widened by ``buffer`` on both sides."""
    low, high = F.col(start) - buffer, F.col(end) + buffer
    met = meet_points(points, F.col(t), intervals, low, high, by, unit)
    return met.where((F.col(t) >= low) & (F.col(t) <= high))


def interval_stats(
    points: DataFrame, intervals: DataFrame, by: list[str], t: str, start: str, end: str, stats: dict[str, tuple[str, Column | int]]
) -> DataFrame:
    """``by``, ``t`` and figures over the intervals that hold each distinct point, without a row per pair; none for points in no interval.

    ``stats``: name to "sum", "min" or "max" and what it is taken of. Times are whole numbers, so cells of one
    unit cover an interval exactly: figures are taken per node, and a point's are those of the nodes above it.
    Intervals and points that many rows share count once in both joins.
    """
    again = [getattr(F, kind)(name).alias(name) for name, (kind, _) in stats.items()]
    # A table of many equal intervals shrinks before it is cut into nodes.
    distinct = intervals.groupBy(*by, start, end).agg(*(getattr(F, kind)(c if isinstance(c, Column) else F.lit(c)).alias(name) for name, (kind, c) in stats.items()))
    nodes = covered(distinct, F.col(start), F.col(end), 1).groupBy(*by, "_node").agg(*again)
    above = F.explode(ancestors(cell(F.col(t), 1), F.col("_levels"))).alias("_node")
    dealt = points.select(*by, t).distinct().withColumn("_levels", levels_of(nodes)).select(*by, t, above)
    return dealt.join(nodes.hint("merge"), [*by, "_node"]).groupBy(*by, t).agg(*again)


def best_overlap(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    bounds: tuple[str, str, str, str],
    key: list[str],
    order: list[str],
    unit: int,
    least: int = 1,
) -> DataFrame:
    """Each left interval's right interval of largest overlap, the first in ``order`` of equal ones.

    ``bounds`` names start and end of the left and of the right interval; overlaps under
    ``least`` (1 at least) don't match. Of two intervals that overlap, either the right one begins inside the
    left one or the left one after the right one's begin and inside it: two searches of points.
    """
    a, b, c, d = map(F.col, bounds)
    left, right = left.where(a <= b), right.where(c <= d)
    begun = meet_points(right, c, left, a, b, by, unit).where((c >= a) & (c <= b))
    inside = meet_points(left, a, right, c, d, by, unit).where((a > c) & (a <= d))
    overlap = F.least(b, d) - F.greatest(a, c)
    pairs = inside.unionByName(begun).withColumn("overlap", overlap).where(F.col("overlap") >= least)
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("overlap"), *order))
    return pairs.withColumn("_place", place).where("_place = 1").drop("_place")


def band_max(left: DataFrame, right: DataFrame, by: list[str], t: str, value: str, width: int, key: list[str], default: float = 0.0) -> DataFrame:
    """``left`` with the greatest ``value`` of right rows less than ``width`` away on either side."""
    r = right.select(*by, F.col(t).alias("_t"), F.col(value).alias("_v")).withColumn("_b", F.explode(F.array(*(F.floor(F.col("_t") / width) + k for k in (-1, 0, 1))))).hint("merge")
    near = left.withColumn("_b", F.floor(F.col(t) / width)).join(r, [*by, "_b"]).where(F.abs(F.col(t) - F.col("_t")) < width)
    best = near.groupBy(*key).agg(F.max("_v").alias(value))
    return left.join(best, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def covering_chunk(
    windows: DataFrame,
    chunks: DataFrame,
    by: list[str],
    window: tuple[str, str],
    chunk: tuple[str, str],
    order: str,
    take: list[str],
    unit: int,
) -> DataFrame:
    """The first chunk in ``order`` that covers each window whole (J13); windows without one get nulls."""
    ws, we = window
    cs, ce = chunk
    c = chunks.select(*dict.fromkeys([*by, cs, ce, order, *take]))
    met = meet_points(windows, F.col(ws), c, F.col(cs), F.col(ce), by, unit)
    held = met.where((F.col(cs) <= F.col(ws)) & (F.col(ce) >= F.col(we)))
    first = held.groupBy(*by, ws, we).agg(F.min_by(F.struct(*take), F.col(order)).alias("_first"))
    return windows.join(first, [*by, ws, we], "left").select(*windows.columns, *(F.col("_first")[t].alias(t) for t in take))


def preferred(left: DataFrame, sources: list[DataFrame], on: list[str], value: str, usable) -> DataFrame:
    """The first source whose value passes ``usable`` (J17); null if none."""
    out, picks = left, []
    for i, s in enumerate(sources):
        out = out.join(s.select(*on, F.col(value).alias(f"_v{i}")), on, "left")
        picks.append(F.when(usable(F.col(f"_v{i}")), F.col(f"_v{i}")))
    return out.withColumn(value, F.coalesce(*picks)).drop(*(f"_v{i}" for i in range(len(sources))))


def overlap_census(left: DataFrame, right: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    """How many keys are on both sides, on one, on neither."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    all_keys = universe.select(key).distinct().join(a, key, "left").join(b, key, "left")
    in_l, in_r = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    return all_keys.agg(F.count_if(in_l & in_r).alias("n_both"), F.count_if(in_l & ~in_r).alias("n_left"), F.count_if(~in_l & in_r).alias("n_right"), F.count_if(~in_l & ~in_r).alias("n_neither"))


def keyed_or_fallback(df: DataFrame, subject: str, admission: str, matched: str) -> DataFrame:
    """Rows matched to their admission; all of a subject's rows where none is."""
    any_match = F.max(F.col(matched).cast("int")).over(Window.partitionBy(subject, admission))
    return df.withColumn("_any", any_match).where((F.col("_any") == 0) | F.col(matched)).drop("_any")
