"""Stores changed in place, checks while writing, signals cut where they lie."""

import os

import pytest
from pyspark.sql import functions as F

from bedside.operators import samples
from bedside.sources import stores

EVENTS = "entity_id string, time_ms long, var_id int, value double, seg_idx int, part string"


def events(spark, rows):
    return spark.createDataFrame([(e, t, v, x, 0, "events") for e, t, v, x in rows], EVENTS)


def listing(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")) for d in os.listdir(path) if d.startswith("bucket=")}


def rows_of(spark, path):
    return sorted((tuple(r) for r in stores.read_store(spark, path).select("entity_id", "time_ms", "var_id", "value").collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    at = str(tmp_path / "store")
    first = [(f"e{i}", t, 0, float(t)) for i in range(40) for t in range(3)] + [(None, 1, 0, None)]
    stores.write_store(events(spark, first), at, 8)
    return at, first


def test_merge_touches_only_buckets_with_new_events(spark, store):
    at, first = store
    before = listing(at)
    more = [("e3", 9, 100, 1.0), ("e3", 9, 100, 1.0), ("e5", 1, 0, 1.0), (None, 1, 0, None)]
    touched = stores.merge_into(spark, at, events(spark, more), 8)
    after = listing(at)
    assert len(touched) == 1 and {b for b in before if before[b] != after[b]} == {f"bucket={touched[0]}"}
    assert rows_of(spark, at) == sorted([*first, more[0]], key=str)
    assert stores.merge_into(spark, at, events(spark, more), 8) == [] and listing(at) == after
    assert stores.merge_into(spark, at, events(spark, []), 8) == []


def test_replace_compares_repeats_and_lone_entities(spark, store):
    at, first = store
    stores.merge_into(spark, at, events(spark, [("e1", 5, 200, 1.0), ("e2", 5, 201, 2.0), ("e3", 5, 300, 3.0)]), 8)
    new = [("e1", 5, 200, 1.0), ("e4", 6, 299, 4.0), ("e4", 6, 299, 4.0), ("e4", 6, 300, 5.0)]
    before = listing(at)
    touched = stores.replace_in(spark, at, events(spark, new), 200, 299, 8)
    want = sorted([*first, ("e3", 5, 300, 3.0), new[0], new[1], new[2]], key=str)
    assert rows_of(spark, at) == want
    after = listing(at)
    assert {b for b in before if before[b] != after.get(b)} == {f"bucket={b}" for b in touched}
    assert stores.replace_in(spark, at, events(spark, new), 200, 299, 8) == [] and listing(at) == after


def test_bucket_that_loses_all_rows_is_emptied(spark, tmp_path):
    at = str(tmp_path / "alone")
    stores.write_store(events(spark, [("e1", 1, 200, 1.0)]), at, 2)
    schema = stores.read_store(spark, at).schema
    stores.replace_in(spark, at, events(spark, []), 200, 299, 2)
    assert stores.read_store(spark, at, schema).count() == 0


def test_checks_while_writing(spark, tmp_path):
    rows = events(spark, [("a", 1, 0, -1.0), ("a", 2, 0, None), ("b", 3, 0, 4.0)])
    checks = [("negative", "error", F.col("value") < 0), ("late", "warning", F.col("time_ms") > 9)]
    want = [("rows", "info", 3, True), ("negative", "error", 1, False), ("late", "warning", 0, True)]
    at = str(tmp_path / "checked")
    assert [tuple(r) for r in stores.write_checked(rows, at, checks, ("part",)).collect()] == want
    assert spark.read.parquet(at).count() == 3
    assert [tuple(r) for r in stores.write_checked(rows, None, checks).collect()] == want
    assert [tuple(r)[2] for r in stores.write_checked(rows.limit(0), None, checks).collect()] == [0, 0, 0]


def signals(spark, n, per=4):
    made = [("a", i, i * 1000, c, f, [float(i * per * k + j) for j in range(per * k)]) for i in range(n) for c, f, k in (("II", 4.0, 1), ("V", 8.0, 2), ("V", 4.0, 1))]
    return spark.createDataFrame(made, "entity_id string, seg_idx int, time_ms long, channel string, fs double, samples array<double>")


INDEX = "entity_id string, var_id int, label_ms long, offset_ms long, value double, t_start long, t_end long, seg_lo int, seg_hi int"


def test_cut_samples_equal_materialised_ones_without_moving_signals(spark, tmp_path):
    s = signals(spark, 40)
    stores.write_signals(s, "cut_signals", str(tmp_path / "signals"), 4, 8, 3)
    index = spark.createDataFrame([("a", 0, i, 0, None, i * 1000 + 250, i * 1000 + 2250, i, i + 2) for i in range(37)], INDEX)
    got = stores.cut_samples(index.union(index.limit(2)), "cut_signals", 4, 8, 3)
    want = samples.materialise(index, s, ["entity_id"])
    key = ["label_ms"]

    def plain(df):
        return [(r.label_ms, sorted(r.waveforms.items())) for r in df.orderBy(*key).collect()]

    assert plain(got) == plain(want) and len(plain(got)) == 37
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = stores.cut_samples(index, "cut_signals", 4, 8, 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Exchanges: distinct rows of the index, and its rows to the table's buckets; none above the join.
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")] and "Bucketed: true" in plan


def test_windows_beyond_the_halo_fail(spark, tmp_path):
    stores.write_signals(signals(spark, 8), "short_halo", str(tmp_path / "signals"), 2, 4, 1)
    index = spark.createDataFrame([("a", 0, 1, 0, None, 0, 3000, 0, 2)], INDEX)
    with pytest.raises(Exception, match="halo"):
        stores.cut_samples(index, "short_halo", 2, 4, 1).collect()
