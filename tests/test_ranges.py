"""Fixed-record files and 16-bit signals read in ranges, against plain decoding."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside.sources import delimited, headers, ranges


def put(path, label="HR", records=(), date=(2024, 2, 29, 23, 59), second=58.25, tail=b""):
    text = b"".join(t.encode().ljust(n, b"\0") for t, n in ((label, 16), ("bpm", 8), ("ICU", 8), ("b1", 4)))
    path.write_bytes(text + struct.pack("<5i", *date) + struct.pack("<d", second) + b"".join(struct.pack("<4d", *r) for r in records) + tail)


@pytest.fixture
def records(tmp_path):
    made = {}
    for name, n in (("a", 1000), ("b", 3), ("c", 0), ("d", 257)):
        made[name] = [(i * 0.5, float(i), i - 1.0, i + 1.0) for i in range(n)]
    (tmp_path / "below").mkdir()
    put(tmp_path / "a.vital", "HR", made["a"])
    put(tmp_path / "b.vital", "SpO2", made["b"], tail=b"cut off")
    put(tmp_path / "c.vital", "HR", made["c"])
    put(tmp_path / "below" / "d.vital", "RR", made["d"], date=(1969, 12, 31, 0, 0), second=0.0)
    put(tmp_path / "bad.vital", "HR", made["b"], date=(2024, 13, 1, 0, 0))
    (tmp_path / "short.vital").write_bytes(b"x")
    (tmp_path / "other.txt").write_bytes(b"x" * 500)
    return tmp_path, made


def test_a_file_is_many_tasks(spark, records):
    folder, made = records
    df = ranges.read_records(spark, str(folder), 32 * 100 + 7)
    assert df.rdd.getNumPartitions() >= 12
    got = df.where(F.col("path").endswith("/a.vital"))
    assert got.select(F.spark_partition_id()).distinct().count() >= 4
    want = [(i, *r) for i, r in enumerate(made["a"])]
    assert [tuple(r) for r in got.orderBy("place").select("place", "value", "offset_s", "low", "high").collect()] == want
    one = got.first()
    assert (one.label, one.uom, one.unit, one.bed, one.start_ms) == ("HR", "bpm", "ICU", "b1", 1709251198250)
    counts = {r.label: (r.n, r.s) for r in df.groupBy("label").agg(F.count("*").alias("n"), F.min("start_ms").alias("s")).collect()}
    assert counts == {"HR": (1000, 1709251198250), "SpO2": (3, 1709251198250), "RR": (257, -86_400_000)}
    assert ranges.read_records(spark, f"file://{folder}/below").count() == 257
    assert ranges.read_records(spark, f"{folder}/none").count() == 0


def test_filters_prune_ranges(spark, records):
    folder, made = records
    df = ranges.read_records(spark, str(folder), 3200)
    some = df.where("place >= 950 AND place < 1000 AND value > 480 AND label IN ('HR', 'RR')")
    assert some.rdd.getNumPartitions() == 1
    assert sorted(r.place for r in some.collect()) == list(range(961, 1000))
    assert df.where("place = 2").count() == 3
    assert df.where("label = 'RR' AND label = 'HR'").count() == 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "value" in plan and "place" not in plan.split("Filter")[1].split("\n")[0]


def test_names_take_what_they_can():
    names = ranges.Names(["label"], "place")
    assert names.take(ranges.GreaterThan(("place",), 5)) and names.take(ranges.LessThanOrEqual(("place",), 9))
    assert names.take(ranges.In(("label",), ("a", "b"))) and names.take(ranges.EqualTo(("label",), "b"))
    assert not names.take(ranges.EqualTo(("value",), 1.0)) and not names.take(ranges.EqualTo(("label", "x"), "b"))
    assert (names.low, names.high) == (6, 10) and names.has("label", "b") and not names.has("label", "a")


def test_signals(spark, tmp_path):
    rng = np.random.default_rng(4)
    raw = rng.integers(-3000, 3000, (1003, 3)).astype("<i2")
    raw[7, 1] = -32768
    (tmp_path / "r1.dat").write_bytes(raw.tobytes() + b"\1")
    head = "# made by hand\nr1 3 125/500 1003 10:20:30.500 01/02/2020\nr1.dat 16 200(-5)/mV 12 0 0 0 0 II\nr1.dat 16 0/NU 12 100 0 0 0 PLETH\nr1.dat 16 50 12 7 0 0 0 ABP mean\n"
    (tmp_path / "r1.hea").write_text(head)
    (tmp_path / "orphan.dat").write_bytes(b"\0" * 100)
    (tmp_path / "timeless.dat").write_bytes(b"\0" * 100)
    (tmp_path / "timeless.hea").write_text("timeless 1 125 50\ntimeless.dat 16 200/mV 12 0 0 0 0 II\n")
    (tmp_path / "other.dat").write_bytes(b"\0" * 100)
    (tmp_path / "other.hea").write_text("other 1 125 50 1:2:3 1/1/2020\nother.dat 212 200/mV 12 0 0 0 0 II\n")
    for size in (10**6, 700, 100):
        df = ranges.read_signals(spark, str(tmp_path), 100, size)
        rows = df.orderBy("channel", "ord").collect()
        assert [(r.channel, r.ord) for r in rows] == [(c, i) for c in ("ABP mean", "II", "PLETH") for i in range(11)]
        for column, (name, gain, base) in enumerate((("II", 200, -5), ("PLETH", 200, 100), ("ABP mean", 50, 7))):
            got = np.concatenate([r.samples for r in rows if r.channel == name])
            want = ((raw[:, column] - float(base)) / gain).astype(np.float32)
            want[raw[:, column] == -32768] = np.nan
            np.testing.assert_array_equal(got, want)
        assert rows[1].start_ms - rows[0].start_ms == 800 and rows[0].start_ms == 1580552430500 and rows[0].fs == 125.0
        assert df.where("channel = 'II' AND entity_id = 'r1'").count() == 11 and df.where("entity_id = 'x'").count() == 0


def test_written_signals_come_back(spark, tmp_path):
    rows = [("p1", 1_600_000_000_250, i, [i + k / 1000 for k in range(10)], [None if k == 3 else float(k) for k in range(10)]) for i in range(5)]
    rows += [("p2", 5, 0, [40.0, float("nan")], [0.0004, 0.0006])]
    df = spark.createDataFrame(rows, "record string, start_ms long, n int, II array<double>, P array<double>").repartition(3)
    made = ranges.write_signals(df, f"{tmp_path}/s", ["II", "P"], 250.0, ["n"])
    assert sorted(r.n for r in made.collect()) == [1, 5]
    got = {(r.entity_id, r.channel): (r.start_ms, r.samples) for r in ranges.read_signals(spark, f"{tmp_path}/s").collect()}
    assert got["p1", "II"][0] == 1_600_000_000_250
    assert [round(x, 3) for x in got["p1", "II"][1]] == [round(i + k / 1000, 3) for i in range(5) for k in range(10)]
    assert [x if x == x else None for x in got["p1", "P"][1][:5]] == [0.0, 1.0, 2.0, None, 4.0]
    assert [x != x for x in got["p2", "II"][1]] == [True, True] and [round(x, 3) for x in got["p2", "P"][1]] == [0.0, 0.001]


def test_written_records_come_back(spark, tmp_path):
    rows = [(f"L{i % 3}", "u", None, "b", 1000 * i, float(i), i, None, 2.5) for i in range(50)]
    df = spark.createDataFrame(rows, "label string, uom string, unit string, bed string, start_ms long, value double, offset_s int, low double, high double")
    assert sorted(r.n for r in ranges.write_records(df.repartition(4), f"{tmp_path}/r", ["offset_s"]).collect()) == [16, 17, 17]
    back = ranges.read_records(spark, f"{tmp_path}/r").orderBy("label", "place").collect()
    want = sorted(rows, key=lambda r: (r[0], r[6]))
    assert [(r.label, r.value, r.offset_s, r.high) for r in back] == [(r[0], r[5], float(r[6]), 2.5) for r in want]
    assert {r.label: r.start_ms for r in back} == {"L0": 0, "L1": 1000, "L2": 2000} and all(r.low != r.low for r in back)


def test_stray_commas(spark):
    lines = {
        "7,dose 2,500 mg,3": "7,dose 2500 mg3",
        "1,250,x 12,345,678,9": "1,250,x 12345678,9",
        "x 1234,567,a": "x 1234567,a",
        'q "a b",5': 'q "a b",5',
        "left  12,3": "left  12,3",
        "left  arm,3": "left  arm3",
        "arm ,3,,4": "arm ,3,,4",
        "5,6.5,-7,8%,9": "5,6.5-7,8%9",
        ",": ",",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in lines], "l string")
    got = {r.l: r.r for r in df.select("l", delimited.without_stray_commas(F.col("l")).alias("r")).collect()}
    assert got == lines
    numbers = spark.createDataFrame([("1,250,x 12,345,678",), ("x 1234,567",), ("x 1,2345",)], "l string")
    assert [r[0] for r in numbers.select(delimited.without_thousands(F.col("l"))).collect()] == ["1,250,x 12345,678", "x 1234,567", "x 1,2345"]


def test_headers_of_many_lines(spark):
    """No line of a header is left out, however many there are."""
    text = "big/1200 2 100 0 10:00:00 01/01/2020\n" + "\n".join(f"s{i} 10" for i in range(150_000))
    one = "r 1500 100 50\n" + "\n".join(f"r.dat 16 200/mV 12 0 0 0 0 c{i}" for i in range(1500))
    df = spark.createDataFrame([("big.hea", text), ("r.hea", one)], "path string, text string")
    assert headers.master_segments(df).agg(F.count("*"), F.max("first_sample")).first()[:] == (150_000, 1_499_990)
    assert headers.channels(df).count() == 1500


def test_header_files_are_read_whole_and_empty_ones_have_no_channels(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "r1.hea").write_text("r1 2 125 250\r\n# note\r\nr1.dat 16 II\r\nr1.dat 16 PLETH\r\n")
    (tmp_path / "a" / "r2.hea").write_text("")
    (tmp_path / "a" / "r3.hea").write_text("# only a note\n")
    (tmp_path / "a" / "r1.dat").write_text("no header")
    found = headers.read_headers(spark, str(tmp_path))
    rows = headers.channels(found)
    assert sorted((r.record, r.fs, r.n_samples, r.channel) for r in rows.collect()) == [("r1", 125.0, 250, "II"), ("r1", 125.0, 250, "PLETH")]
    assert headers.subject_channels(rows, "/(a)/", ["II", "ABP"]).first()[:] == ("a", 2.0, 0.0, ["II", "PLETH"])
    assert headers.master_segments(found).count() == 0


def test_short_ranges_share_tasks(tmp_path):
    (tmp_path / "r.dat").write_bytes(bytes(10_000_000))
    reader = ranges.SignalReader({"path": str(tmp_path), "rangeBytes": "2000", "chunkFrames": "100"}, ranges.Names(["path"]))
    runs = [run for p in reader.partitions() for run in p.runs]
    assert len(reader.partitions()) <= 512 and sum(b - a for _, a, b in runs) == 10_000_000


def test_a_written_file_is_many_tasks(spark, tmp_path):
    df = spark.range(5000, numPartitions=3).select(F.lit("one").alias("label"), F.lit("u").alias("uom"), F.lit("w").alias("unit"), F.lit("b").alias("bed"), F.lit(7000).cast("long").alias("start_ms"), *(F.col("id").cast("double").alias(c) for c in ("value", "offset_s", "low", "high")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = ranges.write_records(df, f"{tmp_path}/r", ["value"])
        assert "rangepartitioning(" in made._jdf.queryExecution().executedPlan().toString()
        assert [(r.path.rsplit("/")[-1], r.n) for r in made.collect()] == [("one.vital", 5000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [f.name for f in (tmp_path / "r").iterdir() if not f.name.endswith(".crc")] == ["one.vital"]
    back = ranges.read_records(spark, f"{tmp_path}/r").orderBy("place").collect()
    assert [(r.place, r.value) for r in back] == [(i, float(i)) for i in range(5000)] and back[0].start_ms == 7000


def test_record_files_share_tasks_and_join_in_order(spark, tmp_path):
    """Labels mixed over all input rows are written in parts; a file of any size is read by 512 tasks at most."""
    mixed = spark.range(6000, numPartitions=3).select(F.concat(F.lit("S"), F.col("id") % 3).alias("label"), F.lit("u").alias("uom"), F.lit("w").alias("unit"), F.lit("b").alias("bed"), F.lit(7000).cast("long").alias("start_ms"), *((6000 - F.col("id")).cast("double").alias(c) for c in ("value", "offset_s", "low", "high")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = ranges.write_records(mixed, f"{tmp_path}/r", ["value"])
        assert sorted((r.path.rsplit("/")[-1], r.n) for r in made.collect()) == [(f"S{i}.vital", 2000) for i in range(3)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = ranges.read_records(spark, f"{tmp_path}/r", 32 * 128).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("rows"))
    assert {r.label: [tuple(x) for x in r.rows] for r in back.collect()} == {f"S{i}": list(enumerate(sorted(6000.0 - n for n in range(i, 6000, 3)))) for i in range(3)}
    with open(tmp_path / "large.vital", "wb") as file:
        file.truncate(64 + 32 * 6_250_000)
    reader = ranges.RecordReader({"path": str(tmp_path / "large.vital"), "rangeBytes": str(4096 * 32)}, ranges.Names(["path", "label"], "place"))
    parts = reader.partitions()
    assert len(parts) <= 512 and sum(b - a for p in parts for _, a, b in p.runs) == 32 * 6_250_000
