"""Dyadic nodes against plain loops, and the interval joins that use them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from bedside.operators import intervals, rangejoin


def test_cover_is_disjoint_whole_and_short(spark):
    rng = random.Random(2)
    rows = [(0, 0), (-1, 0), (-8, 7), (5, 4), (1, 6), (-3, -3)]
    for magnitude in range(7):
        for _ in range(20):
            a = rng.randrange(-(10**6), 10**6)
            rows.append((a, a + rng.randrange(10**magnitude)))
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", intervals.cover(F.col("a"), F.col("b")).alias("nodes"))
    for r in got.collect():
        if r.b < r.a:
            assert r.nodes is None
            continue
        runs = sorted((n.node << n.level, (n.node + 1) << n.level) for n in r.nodes)
        assert runs[0][0] == r.a and runs[-1][1] == r.b + 1
        assert all(x[1] == y[0] for x, y in zip(runs, runs[1:]))
        assert len(runs) <= 2 * max(1, math.ceil(math.log2(r.b - r.a + 1)))


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(6)
    left, right = [], []
    for i in range(150):
        a = rng.randrange(-50_000, 50_000)
        left.append((rng.choice([1, 2, None]), i, a, a + rng.randrange(-2, 10 ** rng.randrange(1, 7))))
        c = rng.randrange(-50_000, 50_000)
        right.append((rng.choice([1, 2, None]), i, c, c + rng.randrange(-2, 10 ** rng.randrange(1, 7))))
    left += [(1, 900, 10, 10), (1, 901, 0, 20), (1, 901, 0, 20)]
    right += [(1, 900, 10, 10), (1, 901, 20, 40), (1, 902, 0, 20)]
    frames = spark.createDataFrame(left, "k int, l long, a long, b long"), spark.createDataFrame(right, "k int, r long, c long, d long")
    return left, right, *frames


@pytest.mark.parametrize("unit", [1, 7, 10_000])
def test_points_in_intervals(sides, unit):
    left, right, lf, rf = sides
    got = rangejoin.points_in_intervals(lf, rf, ["k"], "a", "c", "d", unit, 3).select("l", "r").collect()
    want = [(x[1], y[1]) for x in left for y in right if x[0] is not None and x[0] == y[0] and y[2] - 3 <= x[2] <= y[3] + 3]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("unit", [1, 1000])
def test_best_overlap(sides, unit):
    left, right, lf, rf = sides
    got = rangejoin.best_overlap(lf, rf, ["k"], ("a", "b", "c", "d"), ["l"], ["r"], unit, 5)
    best = {}
    for k, i, a, b in left:
        for j, r, c, d in right:
            overlap = min(b, d) - max(a, c)
            if k is not None and k == j and a <= b and c <= d and overlap >= 5:
                best[i] = min(best.get(i, (-overlap, r)), (-overlap, r))
    assert {r.l: (-r.overlap, r.r) for r in got.collect()} == best


def test_covering_chunk(sides):
    left, right, lf, rf = sides
    got = rangejoin.covering_chunk(lf, rf, ["k"], ("a", "b"), ("c", "d"), "r", ["r"], 10)
    want = []
    for k, i, a, b in left:
        want.append((i, min((r for j, r, c, d in right if k is not None and j == k and c <= a <= d and d >= b), default=None)))
    assert sorted(((r.l, r.r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_rows_of_a_long_interval_are_few(spark):
    """Ten years in cells of a minute, and in cells of a millisecond."""
    year = 365 * 86_400_000
    one = spark.createDataFrame([(1, 7, 10 * year + 7)], "k int, s long, e long")
    for unit in (60_000, 1):
        assert intervals.covered(one, F.col("s"), F.col("e"), unit).count() <= 2 * math.log2(10 * year / unit)


def thick(spark):
    """Points and intervals that are small on disk and large with all their nodes."""
    rows = spark.range(2000).select(F.lit(1).alias("k"), "id", (F.col("id") * 7).alias("s"), (F.col("id") * 7 + 1_000_000).alias("e"))
    points = rows.select("k", F.col("id").alias("point"), F.col("s").alias("t"), F.col("s").alias("u"))
    return points, rows.withColumnRenamed("id", "span")


def merged(joined):
    """Whether nothing is broadcast: Spark's estimates leave out the rows that explode adds."""
    plan = joined._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_best_overlap_broadcasts_no_nodes(spark):
    points, spans = thick(spark)
    assert merged(rangejoin.best_overlap(points, spans, ["k"], ("t", "u", "s", "e"), ["point"], ["span"], 10))
    assert merged(rangejoin.band_max(points, spans.withColumnRenamed("s", "t"), ["k"], "t", "e", 10, ["point"]))


def test_covering_chunk_broadcasts_no_nodes(spark):
    points, spans = thick(spark)
    found = rangejoin.covering_chunk(points, spans, ["k"], ("t", "u"), ("s", "e"), "span", ["span"], 10)
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("BroadcastHashJoin" in line and "_node" in line for line in plan)


def test_points_in_intervals_broadcasts_no_nodes(spark):
    points, spans = thick(spark)
    assert merged(rangejoin.points_in_intervals(points, spans, ["k"], "t", "s", "e", 10))


def test_interval_stats_equal_pairs_without_making_them(spark, sides):
    left, right, lf, rf = sides
    points, spans = lf.select("k", F.col("a").alias("t")), rf.select("k", F.col("r").alias("span"), F.col("c").alias("s"), F.col("d").alias("e"))
    stats = {"n": ("sum", 1), "first": ("min", F.col("span")), "longest": ("max", F.col("e") - F.col("s"))}
    got = {(r.k, r.t): (r.n, r.first, r.longest) for r in rangejoin.interval_stats(points, spans, ["k"], "t", "s", "e", stats).collect()}
    want = {}
    for k, t in {(x[0], x[2]) for x in left if x[0] is not None}:
        over = [(r, d - c) for key, r, c, d in right if key == k and c <= t <= d]
        if over:
            want[k, t] = (len(over), min(r for r, _ in over), max(x for _, x in over))
    assert got == want and len(want) > 50
    # A thousand equal points in a thousand equal intervals are one row.
    many = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("span"), F.lit(0).alias("s"), F.lit(9).alias("e"), F.lit(4).alias("t"))
    assert [tuple(r) for r in rangejoin.interval_stats(many, many, ["k"], "t", "s", "e", stats).collect()] == [(1, 4, 1000, 0, 9)]
