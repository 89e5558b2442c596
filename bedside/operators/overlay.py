"""Sampled arrays laid over one another on a grid, as slices.

A chunk is cut once into one slice per segment it touches; slices, not samples, are shuffled. In a segment
they are laid over one another in order, so the last one wins wherever several have a sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def slices(
    chunks: DataFrame, keep: list[str], first: Column, low: Column, high: Column, samples: str, per_segment: int
) -> DataFrame:
    """``keep``, seg_idx, ``_at`` (place in the segment) and ``_x`` (its samples) of each segment a chunk touches.

    ``first`` is the grid place of a chunk's first sample; samples at places low..high - 1 count.
    """
    bounds = {"_first": first, "_low": low, "_high": high}
    placed = chunks.where(F.col(samples).isNotNull()).select(*keep, F.col(samples).alias("_samples"), *(c.cast("bigint").alias(n) for n, c in bounds.items()))
    last = F.floor((F.col("_high") - 1) / per_segment)
    segments = F.when(F.col("_high") > F.col("_low"), F.sequence(F.floor(F.col("_low") / per_segment), last))

    def one(s: Column) -> Column:
        a = F.greatest(F.col("_low"), s * per_segment)
        b = F.least(F.col("_high"), (s + 1) * per_segment)
        x = F.slice("_samples", (a - F.col("_first") + 1).cast("int"), (b - a).cast("int"))
        return F.struct(s.cast("int").alias("seg_idx"), (a - s * per_segment).cast("int").alias("_at"), x.alias("_x"))

    # Cut before the rows are multiplied: all slices of a chunk are as long as the chunk.
    return placed.select(*keep, F.inline(F.transform(segments, one)))


def overlaid(cut: DataFrame, by: list[str], order: str, per_segment: int) -> DataFrame:
    """``by``, seg_idx and samples: the slices of each segment in ``order``, NaN where there is none.

    Of slices of the same place, length and order the greatest wins. Those of the same place and length are reduced to the last
    one before the exchange, so repeated chunks don't pile up in a segment.
    """
    last = F.max(F.struct(F.col(order).alias("order"), F.col("_x").alias("x")))
    once = cut.groupBy(*by, "seg_idx", "_at", F.size("_x").alias("_n")).agg(last.alias("_last"))
    piece = F.struct("_last.order", F.col("_at").alias("at"), F.col("_n").alias("n"), F.col("_last.x").alias("x"))
    pieces = once.groupBy(*by, "seg_idx").agg(F.sort_array(F.collect_list(piece)).alias("_pieces"))
    nan = F.lit(float("nan")).cast("float")

    def lay(below: Column, p: Column) -> Column:
        end = p["at"] + p["n"]
        return F.concat(F.slice(below, 1, p["at"]), p["x"], F.slice(below, end + 1, F.lit(per_segment) - end))

    # Begun with nulls, so that Spark knows of them in the slices too.
    laid = F.aggregate("_pieces", F.array_repeat(F.lit(None).cast("float"), per_segment), lay)
    return pieces.select(*by, "seg_idx", F.transform(laid, lambda x: F.coalesce(x, nan)).alias("samples"))
