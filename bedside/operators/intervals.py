"""Points and intervals meet by an index of dyadic nodes, so an interval of any length has few rows.

Time is cut into cells of ``unit``. A node of level l is a run of 2**l cells that begins at a multiple of
2**l. Each interval of cells is the disjoint union of at most two nodes a level, a point's cell lies in one node of
each level, and an interval holds a cell just where they share one node. So each pair of a point and an interval around
it meets once, on an equality; nothing depends on how intervals compare with a bucket's width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cell(t: Column, unit: int) -> Column:
    return F.floor(t / unit).cast("bigint")


def _shifted(x: Column, level: Column) -> Column:
    """x / 2**level, rounded down."""
    return F.call_function("shiftright", x, level.cast("int"))


def cover(first: Column, last: Column) -> Column:
    """The nodes (level, node) whose disjoint union is the cells first..last; none if last is before first."""

    def at(level: Column) -> Column:
        low, high = -_shifted(-first, level), _shifted(last + 1, level)
        odd = [(low, low), (high, high - 1)]
        nodes = [F.when((low < high) & (F.pmod(x, F.lit(2)) == 1), F.struct(level.cast("int").alias("level"), node.alias("node"))) for x, node in odd]
        return F.filter(F.array(*nodes), lambda n: n.isNotNull())

    levels = F.floor(F.log2((last - first + 1).cast("double"))).cast("int") + 1
    return F.when(last >= first, F.flatten(F.transform(F.sequence(F.lit(0), levels), at)))


def ancestors(of: Column, levels: Column) -> Column:
    """The node of each level that holds a cell."""
    return F.transform(levels, lambda level: F.struct(level.alias("level"), _shifted(of, level).alias("node")))


def covered(intervals: DataFrame, start: Column, end: Column, unit: int) -> DataFrame:
    """``intervals`` with a row for each node of theirs in ``_node``."""
    return intervals.withColumn("_node", F.explode(cover(cell(start, unit), cell(end, unit))))


def levels_of(spread: DataFrame) -> Column:
    """The levels that ``_node`` has, as a scalar subquery."""
    return spread.agg(F.sort_array(F.collect_set("_node.level")).alias("levels")).select("levels").scalar()


def meet_points(points: DataFrame, t: Column, intervals: DataFrame, start: Column, end: Column, by: list[str], unit: int) -> DataFrame:
    """Pairs of equal ``by`` whose point's cell is one of the interval's; the caller compares the bounds themselves.

    Only levels that intervals have, 64 at most, make rows of points. Spark estimates sizes without the rows that
    ``explode`` adds, so it would broadcast nodes of intervals whose table is small on disk: the join is asked to be a merge.
    """
    spread = covered(intervals, start, end, unit)
    dealt = points.withColumn("_levels", levels_of(spread)).withColumn("_node", F.explode(ancestors(cell(t, unit), F.col("_levels"))))
    return dealt.drop("_levels").join(spread.hint("merge"), [*by, "_node"]).drop("_node")
