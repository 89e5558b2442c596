"""Throttling, overlays, assembled seconds and as-of joins on their hard cases, against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside.operators import asof, samples, segments, throttling


def kept(times, interval):
    out = []
    for t in sorted(set(times)):
        if not out or t - out[-1] >= interval:
            out.append(t)
    return out


def test_chains_and_tables():
    rng = random.Random(1)
    for _ in range(200):
        times = np.array(sorted(rng.sample(range(300), rng.randrange(1, 60))))
        following = throttling.jumps(times, 17)
        ends = throttling.chain_ends(following)
        for i in range(len(times)):
            want = kept(times[i:].tolist(), 17)
            assert times[ends[i]] == want[-1]
            assert times[throttling.chain(following, i)].tolist() == want


@pytest.mark.parametrize("span", [1, 2, 3, 64])
def test_throttle(spark, monkeypatch, span):
    monkeypatch.setattr(throttling, "SPAN", span)
    rng = random.Random(span)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.randrange(-3000, 6000) * rng.choice([1, 1, 40])) for _ in range(1500)]
    rows += [("gap", 1, t) for t in (-(10**9), 0, 99, 100, 10**9, 10**9 + 99, 10**9 + 100)] + [("one", 1, 5)]
    df = spark.createDataFrame(rows, "e string, v int, t long").repartition(5)
    got = throttling.kept_times(df.distinct(), ["e", "v"], "t", 100)
    want = {(e, v, t) for e, v in {r[:2] for r in rows} for t in kept([r[2] for r in rows if r[:2] == (e, v)], 100)}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_a_common_key_is_many_tasks(spark):
    """No bucket of the hot key holds more than its share of time, and tables are short."""
    rng = random.Random(3)
    times = sorted(rng.sample(range(64 * 1000 * 50), 20_000))
    df = spark.createDataFrame([("hot", t) for t in times], "e string, t long")
    dealt = df.select("e", F.col("t").alias("_t"), F.floor(F.col("t") / 64_000).alias("_bucket")).withColumn("_group", F.floor(F.col("_bucket") / 64))
    tables = throttling.bucket_tables(dealt, ["e"], 1000).collect()
    assert len(tables) == 50 and max(len(r._starts) for r in tables) < 40
    assert [r.t for r in throttling.kept_times(df, ["e"], "t", 1000).orderBy("t").collect()] == kept(times, 1000)


def test_throttle_with_null_keys_and_ties(spark):
    rows = [(None, 0, 2.0), (None, 0, 1.0), (None, 99, 3.0), (None, 100, 4.0), ("x", 50, 1.0), ("x", None, 9.0)]
    df = spark.createDataFrame(rows, "e string, t long, v double")
    got = samples.throttle(df.where("t IS NOT NULL"), ["e"], "t", F.lit(True), 100, ["v"]).collect()
    assert sorted(map(tuple, got), key=str) == [("x", 50, 1.0), (None, 0, 1.0), (None, 100, 4.0)]
    assert samples.throttle(df.where("false"), ["e"], "t", F.lit(True), 100, ["v"]).collect() == []


def test_overlay(spark):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        n = rng.randrange(0, 90)
        values = [rng.choice([float(rng.randrange(100)), None, float("nan")]) for _ in range(n)]
        rows.append((rng.choice(["a", None]), i, rng.randrange(-400, 900), 3, 577, values))
    rows += [("a", 500, 40, 3, 577, [7.0] * 60)] * 3 + [("a", 501, -10_000, 3, 577, [1.0] * 5), ("a", 502, 10_000, 3, 577, [1.0] * 5), ("a", 503, 0, 3, 577, None)]
    chunks = spark.createDataFrame(rows, "e string, o int, s long, a long, b long, x array<float>").repartition(4)
    got = segments.place_on_grid(chunks, ["e"], "s", "x", "o", "a", "b", 7, 20)
    grid = {}
    for e, _, s, a, b, x in sorted(rows, key=lambda r: r[1]):
        for i, value in enumerate(x or []):
            if a <= s + 7 * i < b:
                grid[e, (s + 7 * i - a) // 7] = value
    want = {}
    for (e, g), value in grid.items():
        want.setdefault((e, g // 20), [None] * 20)[g % 20] = value if value == value else None
    found = {(r.e, r.seg_idx): [None if v != v else v for v in r.samples] for r in got.collect()}
    assert found == want


def test_overlay_shuffles_slices(spark):
    chunk = spark.createDataFrame([("a", 0, 0, 0, 10**9, [1.0] * 50_000)], "e string, o int, s long, a long, b long, x array<float>")
    from bedside.operators.overlay import slices

    cut = slices(chunk, ["e", "o"], F.lit(5), F.lit(5), F.lit(50_005), "x", 1000)
    assert cut.count() == 51 and cut.agg(F.sum(F.size("_x"))).first()[0] == 50_000


def test_repeated_seconds(spark):
    """The later block of a second counts, usable or not; windows begin at the first second."""
    nan = float("nan")
    rows = [("e", 7, 0, [1.0, 1.0]), ("e", 7, 1, [2.0, 2.0]), ("e", 8, 2, [3.0, 3.0]), ("e", 8, 3, [nan, nan]), ("e", 10, 4, [nan, 4.0]), ("e", 11, 5, [5.0, nan]), ("e", 12, 6, [6.0])]
    df = spark.createDataFrame(rows, "e string, s long, o int, x array<float>").withColumn("first", F.lit(7))
    got = segments.assemble_seconds(df, ["e"], "s", "x", 2, 3, order="o", first_second="first").collect()
    assert [(r.window, r.coverage_s, r.samples[:2]) for r in got] == [(0, 1, [2.0, 2.0])]
    assert segments.assemble_seconds(df, ["e"], "s", "x", 2, 3).count() > 0


def test_as_of_with_null_keys(spark):
    """As in SQL, null matches nothing, within a bucket and across buckets."""
    duckdb = pytest.importorskip("duckdb")
    day = 86_400_000
    left = [(k, t) for k in ("a", None) for t in (5, 10, day + 5, 4 * day)]
    right = [("a", 5, 1), ("a", 2 * day, 2), (None, 5, 3), (None, day, 4), ("b", 5, 5)]
    con = duckdb.connect()
    con.execute("CREATE TABLE l (k VARCHAR, t BIGINT); CREATE TABLE r (k VARCHAR, t BIGINT, v BIGINT)")
    con.executemany("INSERT INTO l VALUES (?, ?)", left)
    con.executemany("INSERT INTO r VALUES (?, ?, ?)", right)
    lf, rf = spark.createDataFrame(left, "k string, t long"), spark.createDataFrame(right, "k string, t long, v long")
    for sign, how in ((">=", {}), (">", {"strict": True}), ("<=", {"forward": True})):
        want = con.execute(f"SELECT l.k, l.t, r.v FROM l ASOF LEFT JOIN r ON l.k = r.k AND l.t {sign} r.t").fetchall()
        got = asof.as_of(lf, rf, ["k"], "t", ["v"], **how).select("k", "t", "v").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    near = asof.nearest(lf, rf, ["k"], "t", "v", 10).collect()
    assert {(r.k, r.t): r.v for r in near}[None, 5] is None and {(r.k, r.t): r.v for r in near}["a", 5] == 1


def test_a_channel_at_two_rates(spark):
    index = spark.createDataFrame([("e", 0, 1000, 0, 5.0, 0, 2000, 0, 1)], "e string, var_id int, label_ms long, offset_ms long, value double, t_start long, t_end long, seg_lo int, seg_hi int")
    rows = [("e", i, i * 1000, "II", fs, [float(fs)] * fs) for i in range(2) for fs in (2, 4)]
    waves = spark.createDataFrame(rows, "e string, seg_idx int, time_ms long, channel string, fs int, samples array<float>")
    assert samples.materialise(index, waves, ["e"]).first().waveforms == {"II": [4.0] * 8}
