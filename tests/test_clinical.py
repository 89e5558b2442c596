"""The smoke scenario, boundary cases and properties of the clinical operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside.functions import clean as C
from bedside.functions import timebase as X
from bedside.operators import aggregates, asof, dedup, quality, resample, samples, segments
from bedside.operators import trajectory as M
from bedside.plans import assembly, scores, splits, tasks
from bedside.schemas import DAY_MS, SEG_BASELINE, SEG_FUTURE, SEG_RECENT
from bedside.sources import delimited, monitors, ranges, registry, sinks

A0, B0 = 1_700_000_000_000, 1_800_000_000_000
BY = ["dataset", "entity_id"]


# Ids, start times, offsets and values of the smoke scenario.
@pytest.fixture(scope="module")
def scenario(spark):
    axis = [("a", "A1", i, A0 + i * 30_000) for i in range(10)]
    axis += [("a", "A2", i, A0 + 10_000_000 + i * 30_000 + (60_000 if i >= 4 else 0)) for i in range(8)]
    axis += [("b", "B1", i, B0 + i * 30_000) for i in range(12)]
    events = [("a", "A1", A0 + t, v, x) for t, v, x in ((60000, 0, 4.2), (150000, 0, 4.5), (270000, 0, 4.0), (90000, 100, 88.0), (200000, 100, 92.0))]
    events += [("a", "A2", A0 + 10_000_000 + t, 0, x) for t, x in ((60000, 3.8), (200000, 4.1))]
    events += [("b", "B1", B0 + t, 0, x) for t, x in ((90000, 5.1), (240000, 4.7))]
    return (
        spark.createDataFrame(axis, "dataset string, entity_id string, seg_idx int, time_ms bigint"),
        spark.createDataFrame(events, "dataset string, entity_id string, time_ms bigint, var_id int, value double"),
    )


def test_smoke_scenario(spark, scenario):
    axis, events = scenario
    found = samples.sample_index(events.where("dataset = 'a'"), axis, BY, [0], 60_000, "end", (1.5, 9))
    got = sorted((r.entity_id, r.label_ms - (A0 if r.entity_id == "A1" else A0 + 10_000_000), r.seg_lo, r.seg_hi) for r in found.collect())
    assert got == [("A1", 60000, 0, 1), ("A1", 150000, 3, 4), ("A1", 270000, 7, 8), ("A2", 60000, 0, 1)]
    middle = samples.sample_index(events, axis, BY, [0], 60_000, "middle")
    assert sorted(r.entity_id for r in middle.collect()) == ["A1"] * 3 + ["A2"] + ["B1"] * 2
    at = asof.as_of(events, axis, BY, "time_ms", ["seg_idx"]).orderBy("entity_id", "var_id", "time_ms").collect()
    assert [r.seg_idx for r in at] == [2, 5, 9, 3, 6, 2, 4, 3, 8]


def test_materialised_windows(spark, scenario):
    axis, events = scenario
    wave = axis.select("*", F.lit("PLETH40").alias("channel"), F.lit(40).alias("fs"), F.transform(F.sequence(F.lit(0), F.lit(1199)), lambda i: (i + F.col("seg_idx") * 1200).cast("float")).alias("samples"))
    index = samples.sample_index(events, axis, BY, [0], 60_000, "end")
    rows = samples.materialise(index, wave, BY).collect()
    assert rows and all(len(r.waveforms["PLETH40"]) == 2400 for r in rows)
    first = next(r for r in rows if r.entity_id == "A1" and r.label_ms == A0 + 150_000)
    assert first.waveforms["PLETH40"][:2] == [3600.0, 3601.0]
    assert segments.rate_errors(wave).count() == 0


@pytest.mark.parametrize(
    "t, window, alignment, want",
    [(155_000, 60_000, "end", (3, 5)), (155_000, 60_000, "middle", (4, 6)), (155_000, 60_000, "start", (5, 7)), (-1, 60_000, "end", None), (299_900, 60_000, "start", None)],
)
def test_window_cases(spark, t, window, alignment, want):
    t0 = 1_000_000_000_000
    axis = spark.createDataFrame([("x", i, t0 + i * 30_000) for i in range(10)], "e string, seg_idx int, time_ms bigint")
    r = samples.locate_windows(spark.createDataFrame([("x", t0 + t)], "e string, time_ms bigint"), axis, ["e"], window, alignment).first()
    assert (r.seg_lo, r.seg_hi) == (want or (None, None))


def test_window_across_a_gap(spark):
    t0 = 1_000_000_000_000
    axis = spark.createDataFrame([("x", i, t0 + i * 30_000 + (60_000 if i >= 3 else 0)) for i in range(6)], "e string, seg_idx int, time_ms bigint")
    labels = spark.createDataFrame([("x", t0 + 3 * 30_000 + 61_000), ("x", t0 + 5 * 30_000 + 65_000)], "e string, time_ms bigint")
    wide = samples.locate_windows(labels.limit(1), axis, ["e"], 120_000, "end").first()
    assert wide.seg_lo is None
    short = samples.locate_windows(labels, axis, ["e"], 30_000, "end").orderBy("time_ms").collect()[-1]
    assert (short.seg_lo, short.seg_hi) == (4, 5)


def test_part_bounds(spark):
    ws, we = 100 * DAY_MS, 100 * DAY_MS + 60_000
    axis = spark.createDataFrame([("x", 0, ws), ("x", 1, ws + 30_000), ("x", 2, we)], "entity_id string, seg_idx int, time_ms bigint")
    times = [ws - DAY_MS, ws - DAY_MS - 1, ws - 1, ws, we, we + 1, ws - 31 * DAY_MS, we + 8 * DAY_MS]
    events = spark.createDataFrame([("x", t, 0, 1.0) for t in times], "entity_id string, time_ms bigint, var_id int, value double")
    got = {r.time_ms: (r.part, r.seg_idx) for r in M.split_events(events, axis).collect()}
    assert got == {times[0]: ("recent", SEG_RECENT), times[1]: ("baseline", SEG_BASELINE), times[2]: ("recent", SEG_RECENT), ws: ("events", 0), we: ("events", 2), we + 1: ("future", SEG_FUTURE)}
    episodes = spark.createDataFrame([("x", ws - 1000, None)], "entity_id string, ep_start bigint, ep_end bigint")
    parts = {r.part for r in M.split_events(events, axis, episodes).collect()}
    assert parts == {"recent", "events", "future"}  # the recent part isn't cut by the episode's start
    split = M.split_events(events, axis)
    assert quality.in_two_parts(split, ["entity_id"]).count() == 0
    assert all(r.errors == [] for r in M.validate_parts(split, axis).collect())
    again = M.add_events(split, events, axis)
    assert again.count() == split.count()


def test_daylight_saving(spark):
    rows = spark.createDataFrame([("03/14/2010 02:57:00",), ("11/03/2019 01:30:00",), ("nonsense",), (None,)], "t string")
    got = [r[0] for r in rows.select(X.local_to_ms(F.col("t"), "MM/dd/yyyy HH:mm:ss", "America/New_York")).collect()]
    assert got == [None, 1572759000000, None, None]


def test_numeric_text(spark):
    rows = spark.createDataFrame([("<5",), ("98%",), ("abc",), ("NaN",), (None,), (" 7.5 ",)], "t string")
    assert [r[0] for r in rows.select(C.numeric_text(F.col("t"))).collect()] == [5.0, 98.0, None, None, None, 7.5]


def test_score_ladders(spark):
    cases = [(6, 1.2, 303, 2.0), (7, 150.0, 302, 0.0), (7, 149.0, 302, 1.0), (108, 15.0, 305, 0.0), (5, 5.0, 306, 4.0)]
    df = spark.createDataFrame([("x", i, v, x) for i, (v, x, _, _) in enumerate(cases)], "e string, time_ms bigint, var_id int, value double")
    got = [(r.var_id, r.value) for r in scores.simple_scores(df, ["e"]).orderBy("time_ms").collect()]
    assert got == [(c, s) for _, _, c, s in cases]
    resp = spark.createDataFrame([("x", 0, 14, 63.0), ("y", 0, 14, 63.0), ("y", 4 * 3_600_000, 203, 0.5)], "e string, time_ms bigint, var_id int, value double")
    assert {r.e: r.value for r in scores.resp_scores(resp, ["e"]).collect()} == {"x": 1.0, "y": 1.0}  # four hours away is too far


def test_throttle_skips_invalid_labels(spark):
    df = spark.createDataFrame([("x", 0, True), ("x", 50, False), ("x", 90, True), ("x", 100, True), ("x", 210, True)], "e string, t bigint, ok boolean")
    assert [r.t for r in samples.throttle(df, ["e"], "t", F.col("ok"), 100, ["t"]).orderBy("t").collect()] == [0, 100, 210]


@pytest.mark.parametrize("source, target", [(125, 40), (40, 125), (500, 120), (60, 60)])
def test_resample_is_direct_convolution(source, target):
    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    g = math.gcd(source, target)
    up, down = target // g, source // g
    got = resample.resample(x, source, target)
    if up == down:
        assert np.allclose(got, x)
        return
    h = resample.design(up, down)
    spaced = np.zeros(len(x) * up)
    spaced[::up] = x
    full = np.convolve(spaced, h)[len(h) // 2 :][: len(spaced)]
    assert np.allclose(got, full[::down])


def test_resample_marks_missing(spark):
    x = [float("nan") if 100 <= i < 200 else 1.0 for i in range(500)]
    df = spark.createDataFrame([("x", x, 100), ("y", None, 100), ("z", [], 100)], "e string, samples array<float>, fs int")
    got = {r.e: r.samples for r in resample.resample_blocks(df, 50).collect()}
    assert got["y"] is None and got["z"] == []
    assert len(got["x"]) == 250 and math.isnan(got["x"][75]) and abs(got["x"][240] - 1) < 0.01


def test_splits_cover_and_never_share_a_patient(spark):
    df = spark.createDataFrame([(i, None if i % 17 == 0 else i // 3, "a" if i % 2 else "b") for i in range(300)], "e bigint, p bigint, s string")
    got = splits.grouped(df, "e", "p", (0.7, 0.15))
    assert got.count() == 300 and quality.split_overlap(got.withColumn("p", F.coalesce("p", F.lit(-1))), "p").count() == 0
    assert sorted(map(tuple, got.select("e", "split").collect())) == sorted(map(tuple, splits.grouped(df, "e", "p", (0.7, 0.15)).select("e", "split").collect()))


def test_merge_is_idempotent(spark, scenario):
    events = scenario[1].drop("dataset")
    once = dedup.merge_events(events, events)
    assert once.count() == events.count() == dedup.merge_events(once, events).count()


def test_dirty_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes('a,note,b\n1,café, au lait,2\n3,"q, r",4\n5,plain,6\n'.encode("latin-1"))
    got = [tuple(r) for r in delimited.read_dirty_csv(spark, str(path), ["a", "note", "b"], fold_into=1).orderBy("a").collect()]
    assert got == [("1", "café, au lait", "2"), ("3", "q, r", "4"), ("5", "plain", "6")]


def test_delimited_reads_plain_and_gzip(spark, tmp_path):
    import gzip

    (tmp_path / "T1.csv").write_text("id,v\n1,<5\n2,\\N\n")
    with gzip.open(tmp_path / "T2.csv.gz", "wt") as f:
        f.write("id,v\n3,NA\n4,7\n")
    got = sorted(map(tuple, delimited.read_delimited(spark, str(tmp_path / "T*.csv*"), ["id", "v"], partitions=2).collect()))
    assert got == [("1", "<5"), ("2", None), ("3", None), ("4", "7")]
    with pytest.raises(ValueError):
        delimited.read_with_header(spark, str(tmp_path / "T1.csv"), ["missing"])


def test_monitor_xml(spark, tmp_path):
    import base64

    wave = base64.b64encode(np.array([1, -2, 300], "<i2").tobytes()).decode()
    m = "".join(f'<m name="{n}">{v}</m>' for n, v in (("Wave", wave), ("Gain", 0.5), ("Offset", 1), ("Points", 3), ("Min", -5), ("Max", 500)))
    (tmp_path / "a.xml").write_text(f'<root><cpc datetime="t1"><measurements><m name="POLLTIME">9</m><mg name="ECG1">{m}</mg></measurements></cpc><cpc datetime="t2"><measurements><mg name="ECG1">{m}</mg></measurements></cpc></root>')
    rows = monitors.monitor_blocks(monitors.read_monitor_xml(spark, str(tmp_path / "a.xml"))).collect()
    assert [(r.block_time, r.channel, r.samples, r.gain) for r in rows] == [("t1", "ECG1", [1.0, -2.0, 300.0], 0.5)]


def test_fixed_records(spark, tmp_path):
    head = b"HR".ljust(16, b"\0") + b"bpm".ljust(8, b"\0") + b"U1".ljust(8, b"\0") + b"B7".ljust(4, b"\0") + np.array([2020, 1, 2, 3, 4], "<i4").tobytes() + np.array([5.5], "<f8").tobytes()
    (tmp_path / "x.vital").write_bytes(head + np.array([[70, 0, 0, 300], [71, 2, 0, 300]], "<f8").tobytes())
    rows = ranges.read_records(spark, str(tmp_path / "x.vital")).orderBy("offset_s").collect()
    assert [(r.label, r.bed, r.value, r.offset_s) for r in rows] == [("HR", "B7", 70.0, 0.0), ("HR", "B7", 71.0, 2.0)]
    assert rows[0].start_ms == 1_577_934_245_500


def test_registry_and_targets(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"variables": [{"id": 0, "name": "Potassium", "physio_min": 1.0, "physio_max": 10.0, "codes": [5, 6]}, {"id": 100, "name": "HR", "physio_min": 0.0, "physio_max": 300.0, "codes": [7]}]}')
    reg = registry.read_registry(spark, str(tmp_path / "r.json"))
    assert sorted(r.code for r in registry.source_codes(reg, "codes").collect()) == ["5", "6", "7"]
    assert tasks.resolve_targets(reg, ["hr", 0]) == [100, 0]
    with pytest.raises(KeyError):
        tasks.resolve_targets(reg, ["nothing"])


def test_sinks(spark, scenario, tmp_path):
    axis, events = scenario
    t = M.split_events(events, axis, by=BY)
    sinks.write_trajectory(t, str(tmp_path / "t"), partitions=2)
    assert spark.read.parquet(str(tmp_path / "t")).count() == t.count()
    sinks.write_trajectory(t, str(tmp_path / "dry"), dry_run=True)
    assert not (tmp_path / "dry").exists()
    meta = {r.entity_id: r.n_by_part for r in sinks.entity_meta(t, BY, 2).collect()}
    assert meta["A1"] == {"events": 5}
    done = sinks.entity_meta(t.where("entity_id = 'A1'"), BY, 2)
    assert sorted(r.entity_id for r in assembly.not_yet_done(axis.select("entity_id").distinct(), done, 2).collect()) == ["A2", "B1"]


def test_manifest_finds_errors(spark, scenario):
    axis, events = scenario
    wave = axis.select("*", F.lit("II120").alias("channel"), F.lit(1).alias("fs"), F.array_repeat(F.lit(0.0).cast("float"), 30).alias("samples")).where("NOT (entity_id = 'B1' AND seg_idx = 3)")
    got = {r.entity_id: r for r in quality.manifest(axis, wave, M.split_events(events, axis, by=BY), BY, ["II120"]).collect()}
    assert got["A1"].valid and got["A2"].n_gaps == 1 and not got["B1"].valid
    assert got["B1"].errors == ["segments and axis differ"]


def test_coverage_and_leak(spark, scenario):
    axis, events = scenario
    t = M.split_events(events, axis, by=BY)
    c = {r.var_id: r for r in aggregates.coverage(aggregates.event_counts(t, BY), 3).collect()}
    assert (c[0].eligible_1, c[0].eligible_3, c[0].median_events, c[0].total_events) == (3, 1, 2, 7)
    leak = M.part_summary(t.withColumn("part", F.lit("future")).withColumn("var_id", F.lit(200)), BY)
    with pytest.raises(Exception, match="future"):
        M.assert_no_leak(leak).collect()


def test_stream(spark, scenario, tmp_path):
    from bedside.streaming.align import split_stream

    axis, events = scenario
    events.write.parquet(str(tmp_path / "in"))
    q = split_stream(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), axis, BY).writeStream.format("memory").queryName("parted").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("parted").where("part = 'events'").count() == 9


def test_rules_of_treatments(spark):
    """Values written from the published rules, not from the code."""
    from bedside.plans import actions

    assert math.isclose(actions.DOSE_FACTORS["phenylephrine"], 0.00125) and actions.DOSE_FACTORS["dopamine"] == 0.01
    rows = [("01-Drug Push BOLUS", 0.0, 5.0), ("bolus", 5000.0, None), ("bolus", 5001.0, None), ("Fluids", 10.0, 2000.0), ("Fluids", 10.0, 2001.0), ("Fluids", 0.0, 9.0), (None, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "category string, amount double, rate double")
    assert sorted((r.var_id, r.value) for r in actions.fluids(df).collect()) == [(201, 2000.0), (202, 5000.0)]
    charted = [("x", 0, 203, 50.0), ("x", 1, 203, 0.5), ("x", 2, 203, 20.0), ("x", 3, 204, 31.0), ("x", 3, 204, 5.0), ("x", 4, 206, 0.0), ("x", 5, 206, 2501.0), ("x", 6, 203, float("nan"))]
    got = actions.charted(spark.createDataFrame(charted, "e string, time_ms bigint, var_id int, value double"), ["e"]).collect()
    assert sorted((r.time_ms, r.value) for r in got) == [(0, 0.5), (3, 5.0), (4, 0.0)]


def test_onset_and_score_flags(spark):
    assert scores.ONSET == 307
    rows = [("a", "future", 307), ("b", "future", 306), ("c", "events", 307), ("d", "future", 399), ("e", "future", 299)]
    df = spark.createDataFrame(rows, "entity_id string, part string, var_id int")
    got = {r.entity_id: (r.has_future_actions, r.has_future_scores, r.has_future_onset) for r in M.part_summary(df).collect()}
    assert got == {"a": (False, False, True), "b": (False, True, False), "c": (False,) * 3, "d": (False,) * 3, "e": (True, False, False)}


def test_scaled_samples(spark):
    df = spark.createDataFrame([([-32768.0, -32767.0, 32767.0, 100.0, 101.0, -50.0],)], "s array<float>")
    got = df.select(C.valid_samples(F.col("s"), F.lit(-9.0), F.lit(51.0), F.lit(0.5), F.lit(1.0), (-32767, 32767))).first()[0]
    assert [None if math.isnan(x) else x for x in got] == [None, None, None, 51.0, None, None]
    free = df.select(C.valid_samples(F.col("s"), F.lit(None).cast("double"), F.lit(51.0), F.lit(0.5), F.lit(1.0))).first()[0]
    assert free[0] == -16383.0


def test_throttle_keeps_the_first_of_equal_times(spark):
    df = spark.createDataFrame([("x", 10, 2.0), ("x", 10, 1.0), ("x", 60, 3.0), ("x", 111, 4.0), ("y", 10, 5.0)], "e string, t bigint, v double")
    got = samples.throttle(df, ["e"], "t", F.lit(True), 100, ["v"])
    assert sorted((r.e, r.t, r.v) for r in got.collect()) == [("x", 10, 1.0), ("x", 111, 4.0), ("y", 10, 5.0)]


def test_a_window_beyond_its_signal_is_an_error(spark, scenario):
    axis, events = scenario
    wave = axis.select("*", F.lit("II").alias("channel"), F.lit(1).alias("fs"), F.array_repeat(F.lit(0.0).cast("float"), 20).alias("samples"))
    index = samples.sample_index(events, axis, BY, [0], 60_000, "end")
    with pytest.raises(Exception, match="beyond its signal"):
        samples.materialise(index, wave, BY).collect()


def test_tasks_count_entities_without_events(spark):
    counts = spark.createDataFrame([("a", "events", 0, 3), ("b", "recent", 0, 9)], "e string, part string, var_id int, n bigint")
    entities = spark.createDataFrame([("a",), ("b",), ("c",)], "e string")

    def got(least, kind):
        return sorted(map(tuple, tasks.build_task(counts, entities, tasks.TaskSpec("t", (0, 1), least, kind), ["e"]).collect()))

    assert got(0, "all") == [("a",), ("b",), ("c",)] and got(1, "any") == [("a",)] and got(1, "all") == []
    assert len(got(0, "per_target")) == 6 and got(3, "per_target") == [("a", 0)]


def test_labels_lines_and_steps(spark):
    df = spark.createDataFrame([("C HR",), ("C odd",), ("SpO2",), (None,)], "t string")
    assert [r[0] for r in df.select(C.garbled_label(F.col("t"), ["HR"])).collect()] == ["HR", "C odd", "SpO2", ""]
    lines = spark.createDataFrame([("1,CO2, ALT low,2,3",), ("a 1,234,5",)], "l string")
    assert [r[0] for r in lines.select(delimited.without_stray_commas(F.col("l"))).collect()] == ["1,CO2 ALT low2,3", "a 12345"]
    held = spark.createDataFrame([("x", i, v) for i, v in enumerate([1.0, float("nan"), 1.2, None, 2.0])], "e string, t int, v double")
    assert [r.t for r in segments.step_changes(held, ["e"], "t", "v").orderBy("t").collect()] == [0, 4]
    times = spark.createDataFrame([("x", "c", t) for t in (0, 1, 2, 3)] + [("y", "c", t) for t in (0, 10, 20)] + [("z", "c", 0), ("z", "c", 5)], "e string, code string, t int")
    r = aggregates.cadence(times, "code", ["e"], "t").first()
    assert (r.n_entities, r.median_step, r.least_step, r.greatest_step) == (2, 5.5, 1, 10)


@pytest.fixture(scope="module")
def ragged(spark):
    """A large, a small and a null entity on axes with gaps, in mixed order."""
    rng = np.random.default_rng(3)
    rows = []
    for e, n in (("big", 150), ("small", 3), (None, 20)):
        t = np.cumsum(rng.choice([10, 10, 10, 35], n)) - 200
        rows += [(e, int(x)) for x in rng.permutation(t)]
    return rows, spark.createDataFrame(rows, "e string, t bigint")


def by_entity(rows):
    out = {}
    for e, *rest in rows:
        out.setdefault(e, []).append(tuple(rest) if len(rest) > 1 else rest[0])
    return {e: sorted(x) for e, x in out.items()}


@pytest.mark.parametrize("width", [1, 40, 10**6])
def test_buckets_do_not_change_an_axis(ragged, width):
    rows, axis = ragged
    numbered = segments.number_segments(axis, ["e"], "t", width)
    runs = segments.islands(numbered, ["e"], "t", 10, 1, width)
    want, report = set(), set()
    for e, ts in by_entity(rows).items():
        run = gaps = 0
        for i, t in enumerate(ts):
            if i and abs(t - ts[i - 1] - 10) > 1:
                run += 1
                gaps += 1
            want.add((e, t, i, run))
        report.add((e, len(ts), ts[0], ts[-1], True, gaps))
    assert {tuple(r) for r in runs.select("e", "t", "seg_idx", "island_id").collect()} == want
    got = segments.axis_report(numbered, ["e"], "t", 10, width)
    assert {tuple(r) for r in got.select("e", "n_seg", "wave_start", "wave_end", "increasing", "n_gaps").collect()} == report
    falling = numbered.withColumn("t", F.when(F.col("seg_idx") == 2, -1000).otherwise(F.col("t")))
    assert {r.increasing for r in segments.axis_report(falling, ["e"], "t", 10, width).collect()} == {False}


@pytest.mark.parametrize("width", [1, 7, 10**6])
def test_buckets_do_not_change_runs_and_changes(spark, width):
    rng = np.random.default_rng(4)
    rows = [(e, i, float(rng.integers(0, 4)) if rng.random() < 0.8 else None, bool(rng.random() < 0.3)) for e, n in (("big", 120), ("small", 2), (None, 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "e string, i bigint, v double, bad boolean")
    blocks, changes = set(), set()
    for e, part in by_entity([(e, i, bad, -1.0 if v is None else v) for e, i, v, bad in rows]).items():
        block, usable, held = -1, False, None
        for i, bad, v in part:
            block += not bad and not usable
            usable = not bad
            if not bad:
                blocks.add((e, i, block))
            if v >= 0:
                if held is None or abs(v - held) > 1.5:
                    changes.add((e, i))
                held = v
    assert {(r.e, r.i, r.block_id) for r in segments.anchor_blocks(df, ["e"], "i", F.col("bad"), width).collect()} == blocks
    assert {(r.e, r.i) for r in segments.step_changes(df, ["e"], "i", "v", 1.5, width).collect()} == changes


@pytest.mark.parametrize("width", [1, 5, 10**6])
def test_buckets_do_not_change_a_grid(spark, width):
    rng = np.random.default_rng(5)
    axis = [(e, i) for e, n in (("big", 60), ("small", 1)) for i in range(n)]
    events = [(e, i, 7, 100 * i + k, float(rng.integers(0, 50))) for e, i in axis if rng.random() < 0.15 for k in (1, 2)]
    grid = segments.dense_grid(spark.createDataFrame(axis, "e string, seg_idx int"), spark.createDataFrame(events, "e string, seg_idx int, var_id int, time_ms bigint, value double"), ["e"], [7, 8], width)
    have = {(e, i): v for e, i, _, _, v in events}
    want = {}
    for e, i in axis:
        a = max((j for f, j in have if f == e and j <= i), default=None)
        b = min((j for f, j in have if f == e and j >= i), default=None)
        if (e, i) in have:
            want[e, i, 7] = (2, have[e, i])
        elif a is not None and b is not None:
            want[e, i, 7] = (1, have[e, a] + (have[e, b] - have[e, a]) * (i - a) / (b - a))
        else:
            want[e, i, 7] = (0, None)
        want[e, i, 8] = (0, None)
    got = {(r.e, r.seg_idx, r.var_id): (r.mask, r.value) for r in grid.collect()}
    assert {k: m for k, (m, _) in got.items()} == {k: m for k, (m, _) in want.items()}
    assert all(got[k][1] == (v if v is None else pytest.approx(v)) for k, (_, v) in want.items())


def test_percentiles_by_counts(spark):
    rng = np.random.default_rng(6)
    groups = {"normal": rng.normal(0, 5, 401), "ties": rng.integers(0, 3, 200).astype(float), "one": np.array([2.5]), "wide": np.append(rng.random(50), 1e300), None: rng.random(10)}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("normal", None), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p01, r.median, r.p99) for r in aggregates.norm_stats(df, "g", "v").collect()}
    assert got.pop("nothing") == (None, None, None) and set(got) == set(groups)
    for g, xs in groups.items():
        assert got[g] == pytest.approx(np.quantile(xs, [0.01, 0.5, 0.99]))
    quality = {r.g: (r.n, r.median_abs, r.p05, r.p95) for r in aggregates.match_quality(df, ["g"], "v").collect()}
    assert quality["nothing"] == (0, None, None, None)
    for g, xs in groups.items():
        assert quality[g] == pytest.approx((len(xs), np.median(np.abs(xs)), *np.quantile(xs, [0.05, 0.95])))
