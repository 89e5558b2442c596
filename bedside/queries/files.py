"""Queries that write a table in a source's or sink's format to the shared folder and read it back, and whole assemblies."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from bedside.functions import clean as C
from bedside.operators import aggregates as A
from bedside.operators import mapping, quality, samples, segments
from bedside.operators import trajectory as M
from bedside.plans import actions, assembly, scores, splits, tasks
from bedside.plans.monitors import monitor_windows
from bedside.queries.common import DAY, ORACLES, axis, clean, episodes, query, raw_events, registry, sql, table, trajectory
from bedside.queries.timeline import _samples_sql
from bedside.sources import delimited, headers, monitors, ranges, sinks, stores
from bedside.sources import registry as R

E1 = ["entity_id"]
HOUR = 3_600_000


def place(spark, name: str) -> str:
    return f"{sinks.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer")
def delimited_files(spark, sf):
    """Gzip files with tokens that mean null, read as text and cast."""
    columns = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
    at = place(spark, "delimited")
    table(spark, sf, "customer").select(*columns).write.option("header", True).option("compression", "gzip").csv(at)
    texts = delimited.read_delimited(spark, f"{at}/*.csv.gz", columns, ["", "BUILDING"], partitions=4)
    return delimited.cast_columns(texts, {"c_custkey": "bigint", "c_acctbal": "double"})


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def header_files(spark, sf):
    """Header names with spaces around them."""
    at = place(spark, "header")
    s = table(spark, sf, "supplier")
    s.select(F.col("s_suppkey").alias(" s_suppkey "), F.col("s_name").alias("s_name ")).write.option("header", True).csv(at)
    return delimited.read_with_header(spark, at, ["s_suppkey", "s_name"]).select("s_suppkey", "s_name")


@query("SELECT CAST(n_regionkey * 100 + 1 AS VARCHAR) AS code, n_nationkey AS var_id, CAST(n_regionkey AS DOUBLE) AS physio_min, n_regionkey + 10.5 AS physio_max FROM nation UNION ALL SELECT n_name, n_nationkey, CAST(n_regionkey AS DOUBLE), n_regionkey + 10.5 FROM nation")
def registry_file(spark, sf):
    """One JSON document of variables with their codes; nations stand in for variables."""
    n = table(spark, sf, "nation")
    codes = F.array((F.col("n_regionkey") * 100 + 1).cast("string"), "n_name")
    variable = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("double").alias("physio_min"), (F.col("n_regionkey") + 10.5).alias("physio_max"), codes.alias("codes"))
    at = place(spark, "registry")
    n.agg(F.collect_list(variable).alias("variables")).write.json(at)
    return R.source_codes(R.read_registry(spark, at), "codes").withColumn("var_id", F.col("var_id").cast("int"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'train' ELSE 'test' END AS split FROM customer WHERE c_acctbal > 0 AND c_custkey % 3 <> 2")
def split_files(spark, sf):
    """Published id lists, one id a line under a header, cut down to valid entities."""
    c = table(spark, sf, "customer")
    lists = {}
    for name, rest in (("train", 0), ("test", 1)):
        at = place(spark, name)
        c.where(F.col("c_custkey") % 3 == rest).select(F.col("c_custkey").alias("entity_id")).write.option("header", True).csv(at)
        lists[name] = R.read_id_list(spark, at, "c_custkey")
    return splits.adopt(lists, c.where("c_acctbal > 0").select(F.col("c_custkey").cast("bigint")), "c_custkey")


RECORDS = """r AS (
  SELECT 'S' || l_suppkey % 7 AS label, l_quantity AS value, CAST(l_linenumber AS DOUBLE) AS offset_s, l_discount AS low, l_tax AS high,
    row_number() OVER (PARTITION BY l_suppkey % 7 ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax) - 1 AS place
  FROM lineitem
)"""
RECORD_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "value", "low", "high"]


def _records(spark, sf):
    """Line items as fixed-record files, one per group of suppliers, read in ranges of 4,096 records."""
    item = table(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey") % 7).alias("label"),
        F.lit("u").alias("uom"),
        F.lit("ICU").alias("unit"),
        F.lit("b1").alias("bed"),
        F.lit(1_600_000_000_500).alias("start_ms"),
        F.col("l_quantity").alias("value"),
        F.col("l_linenumber").alias("offset_s"),
        F.col("l_discount").alias("low"),
        F.col("l_tax").alias("high"),
        *RECORD_ORDER[:3],
    )
    at = place(spark, "records")
    ranges.write_records(item, at, RECORD_ORDER).collect()  # a row per file
    return ranges.read_records(spark, at, 4096 * 32)


@query(f"""WITH {RECORDS}
SELECT label, CAST(1600000000500 AS BIGINT) AS start_ms, place // 1000 AS thousand, count(*) AS n, round(sum(value), 4) AS total,
  round(sum(offset_s), 4) AS offsets, round(sum(low * (1 + place)), 4) AS lows, round(sum(high * (1 + place)), 4) AS highs
FROM r GROUP BY ALL""")
def record_files(spark, sf):
    weight = F.col("place") + 1
    sums = {"total": F.col("value"), "offsets": F.col("offset_s"), "lows": F.col("low") * weight, "highs": F.col("high") * weight}
    rows = _records(spark, sf).groupBy("label", "start_ms", F.floor(F.col("place") / 1000).alias("thousand"))
    return rows.agg(F.count("*").alias("n"), *(F.round(F.sum(c), 4).alias(name) for name, c in sums.items()))


@query(f"WITH {RECORDS} SELECT label, place, value, offset_s, low, high FROM r WHERE label IN ('S2', 'S5') AND place >= 600 AND place < 5000 AND value > 40")
def record_ranges(spark, sf):
    """Files and ranges that can't match aren't opened; the value is compared by Spark."""
    rows = _records(spark, sf).where("label IN ('S2', 'S5') AND place >= 600 AND place < 5000 AND value > 40")
    return rows.select("label", "place", "value", "offset_s", "low", "high")


@query("""WITH f AS (
  SELECT label, CAST(i - 1 + 64 * (row_number() OVER (PARTITION BY label, i ORDER BY vec_id) - 1) AS BIGINT) AS frame, CAST(embedding[i] AS DOUBLE) AS x
  FROM embeddings, unnest(range(1, 65)) AS u(i)
), c AS (
  SELECT label, frame, 'II' AS channel, round(x * 1000) AS x FROM f
  UNION ALL SELECT label, frame, 'PLETH', CASE WHEN x > 0.25 THEN NULL ELSE round(x * -2000) END FROM f
)
SELECT 'p' || label AS entity_id, channel, frame // 100 AS ord, 1600000000000 + frame // 100 * 800 AS start_ms, CAST(125 AS DOUBLE) AS fs,
  count(*) AS n, count(x) AS n_valid, CAST(coalesce(sum(x * (1 + frame % 100)), 0) AS BIGINT) AS total
FROM c GROUP BY ALL""")
def raw_chunks(spark, sf):
    """Two channels of 16-bit signals, written with their headers and read in chunks of 100 frames."""
    x = F.col("embedding")
    loud = F.transform(x, lambda v: F.when(v <= 0.25, v.cast("double") * -2))
    e = table(spark, sf, "embeddings").select(
        F.concat(F.lit("p"), "label").alias("record"), F.lit(1_600_000_000_000).alias("start_ms"), "vec_id", x.alias("II"), loud.alias("PLETH")
    )
    at = place(spark, "signals")
    ranges.write_signals(e, at, ["II", "PLETH"], 125.0, ["vec_id"]).collect()  # a row per file
    back = ranges.read_signals(spark, at, 100, 2_000)
    scaled = F.transform("samples", lambda v, i: F.when(F.isnan(v), 0).otherwise(F.round(v.cast("double") * 1000)).cast("bigint") * (i + 1))
    return back.select(
        "entity_id",
        "channel",
        "ord",
        "start_ms",
        "fs",
        F.size("samples").cast("bigint").alias("n"),
        F.size(F.filter("samples", lambda v: ~F.isnan(v))).cast("bigint").alias("n_valid"),
        F.aggregate(scaled, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total"),
    )


@query("SELECT c_custkey, c_acctbal < 0 AS died FROM customer")
def labelled_patients(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("mortality_reward"))
    return R.labelled_patients(c).drop("mortality_reward")


@query(sql("SELECT 'listed' AS way, entity_id FROM bounds WHERE n_seg > 2 UNION ALL SELECT 'split', entity_id FROM bounds WHERE CAST(entity_id AS BIGINT) % 4 = 1 UNION ALL SELECT 'axis', entity_id FROM bounds"))
def resolved_entities(spark, sf):
    ax = axis(spark, sf)
    listed = M.axis_bounds(ax, E1).where("n_seg > 2")
    split = ax.select("entity_id", F.when(F.col("entity_id").cast("bigint") % 4 == 1, "test").otherwise("train").alias("split"))
    ways = {"listed": R.resolve_entities(ax, explicit=listed), "split": R.resolve_entities(ax, splits=split, split="test"), "axis": R.resolve_entities(ax)}
    out = None
    for way, found in ways.items():
        rows = found.select(F.lit(way).alias("way"), "entity_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(sql("SELECT entity_id, time_ms, var_id, value FROM cleaned"))
def events_file(spark, sf):
    at = place(spark, "events")
    sinks.write_events(clean(spark, sf), at)
    return spark.read.parquet(at)


@query(sql("SELECT entity_id, time_ms, var_id, value, seg_idx, part FROM traj"))
def trajectory_files(spark, sf):
    """One folder per part; a dry run writes nothing."""
    at = place(spark, "trajectory")
    t = trajectory(spark, sf).select("entity_id", "time_ms", "var_id", "value", "seg_idx", "part")
    sinks.write_trajectory(t, f"{at}/dry", ("part",), dry_run=True)
    sinks.write_trajectory(t, f"{at}/t", ("part",), partitions=4)
    return spark.read.parquet(f"{at}/t")


@query("SELECT CAST(label AS VARCHAR) AS entity_id, CASE vec_id % 2 WHEN 0 THEN 'II' ELSE 'PLETH' END AS channel, count(*) AS n, round(sum(CAST(embedding[1] AS DOUBLE)), 4) AS total FROM embeddings GROUP BY ALL")
def segment_files(spark, sf):
    """One folder per channel."""
    at = place(spark, "segments")
    e = table(spark, sf, "embeddings")
    rows = e.select(F.col("label").cast("string").alias("entity_id"), F.col("vec_id").alias("seg_idx"), F.when(F.col("vec_id") % 2 == 0, "II").otherwise("PLETH").alias("channel"), F.col("embedding").alias("samples"))
    sinks.write_segments(rows, at)
    back = spark.read.parquet(at)
    return back.groupBy("entity_id", "channel").agg(F.count("*").alias("n"), F.round(F.sum(F.col("samples")[0].cast("double")), 4).alias("total"))


@query(sql("SELECT part AS status, count(*) AS n FROM traj GROUP BY 1"))
def summary_file(spark, sf):
    at = place(spark, "summary")
    sinks.write_json(sinks.run_summary(trajectory(spark, sf), "part"), at)
    return spark.read.json(at).select("status", "n")


@query("SELECT CAST(c_custkey AS VARCHAR) AS entity_id, c_mktsegment AS site, CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM customer")
def demographics_file(spark, sf):
    at = place(spark, "demographics")
    c = table(spark, sf, "customer")
    sinks.write_demographics(c.select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("site"), F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("nation")), at)
    return delimited.read_delimited(spark, at, ["entity_id", "site", "nation"])


@query("""SELECT 'out/' || o_orderkey AS dir, CAST(o_custkey AS VARCHAR) AS patient, CAST(0 AS BIGINT) AS first, coalesce(n, 0) AS n_seg, CAST(-1 AS BIGINT) AS onset, CAST(0 AS BIGINT) AS label, CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1) ON l_orderkey = o_orderkey""")
def split_list_files(spark, sf):
    """Rows of six fields, one folder per split."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("entity_id"), "o_custkey", F.when(F.col("o_orderkey") % 5 == 0, "test").otherwise("train").alias("split"))
    sizes = table(spark, sf, "lineitem").where("l_quantity > 10").groupBy(F.col("l_orderkey").cast("string").alias("entity_id")).agg(F.count("*").alias("n_seg"))
    at = place(spark, "splits")
    sinks.write_split_lists(tasks.downstream_rows(o, sizes, "entity_id", "o_custkey", "out"), at)
    return spark.read.json(at).select("dir", "patient", "first", "n_seg", "onset", "label", "split")


@query(sql("""SELECT entity_id, count(*) FILTER (part = 'baseline') AS n_baseline, count(*) FILTER (part = 'recent') AS n_recent, count(*) FILTER (part = 'events') AS n_events, count(*) FILTER (part = 'future') AS n_future, CAST(0 AS BIGINT) AS n_errors FROM traj GROUP BY 1"""))
def assembled(spark, sf):
    """Labs, vitals and actions cleaned apart, then assembled with their summary and errors."""
    raw, reg, ep = raw_events(spark, sf), registry(spark), episodes(spark, sf)
    policy = assembly.Policy(pad_ms=DAY)
    sources = [assembly.clean_events(raw, reg.where(C.band(F.col("var_id"), kind)), ["event_type"], policy) for kind in ("lab", "vital", "action")]
    _, errors, summary = assembly.assemble(sources, axis(spark, sf), ep, policy)
    bad = errors.groupBy("entity_id").agg(F.sum(F.size("errors")).alias("n_errors"))
    return summary.join(bad, "entity_id").select("entity_id", "n_baseline", "n_recent", "n_events", "n_future", "n_errors")


@query(sql("SELECT var_id, count(*) AS n, max(value) AS high FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, time_ms, var_id ORDER BY event_type, value) AS rn FROM raw JOIN reg USING (event_type) WHERE value IS NOT NULL AND CASE var_id WHEN 100 THEN value BETWEEN 0.5 AND 60 WHEN 0 THEN value BETWEEN 20 AND 300 ELSE physio_min IS NULL OR physio_max IS NULL OR value BETWEEN physio_min AND physio_max END) WHERE rn = 1 GROUP BY 1"))
def range_override(spark, sf):
    """Ranges that one dataset replaces, one bound or both."""
    overrides = spark.sql("SELECT * FROM VALUES (100, CAST(NULL AS DOUBLE), 60.0D), (0, 20.0D, CAST(NULL AS DOUBLE)) AS t(var_id, physio_min, physio_max)")
    ev = assembly.clean_events(raw_events(spark, sf), registry(spark), ["event_type"], overrides=overrides)
    return ev.groupBy("var_id").agg(F.count("*").alias("n"), F.max("value").alias("high"))


@query("SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_linestatus = 'F' THEN 2 ELSE 3 END AS INTEGER) AS var_id FROM lineitem WHERE (l_returnflag, l_linestatus) IN (('A', 'F'), ('R', 'F'), ('N', 'O'))")
def two_column_map(spark, sf):
    codes = spark.sql("SELECT * FROM VALUES ('A', 'F', 1), ('R', 'F', 2), ('N', 'O', 3) AS t(l_returnflag, l_linestatus, var_id)")
    return mapping.map_codes(table(spark, sf, "lineitem"), codes, ["l_returnflag", "l_linestatus"]).select("l_orderkey", "l_linenumber", "var_id")


@query("""SELECT c_custkey, coalesce(n, 0) AS n_files, coalesce(has_f, false) AS has_f FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, bool_or(o_orderstatus = 'F') AS has_f FROM orders GROUP BY 1) ON o_custkey = c_custkey
ORDER BY -CAST(coalesce(has_f, false) AS INTEGER), abs(coalesce(n, 0) - 10), c_custkey LIMIT 25""")
def ranked_candidates(spark, sf):
    """By several keys: a flag first, then the distance from a wished number."""
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.bool_or(F.col("o_orderstatus") == "F").alias("f"))
    c = table(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_files"), F.coalesce("f", F.lit(False)).alias("has_f"))
    return A.ranked(c, [F.desc("has_f"), F.abs(F.col("n_files") - 10), F.col("c_custkey")], 25)


@query("""SELECT l_orderkey, l_linenumber, x > 0 AS positive, x >= 0 AND NOT (l_linenumber = 1 AND x = 0) AS charted, big > -1e6 AND big < 1e6 AS sane, l_quantity >= 10 AND l_quantity < 20 AS inside
FROM (SELECT *, CAST(l_quantity AS BIGINT) - 25 AS x, (CAST(l_quantity AS BIGINT) - 25) * 50000.0 AS big FROM lineitem)""")
def monitor_filters(spark, sf):
    """Each filter alone, on negative, zero and positive values and on both bounds."""
    x = F.col("l_quantity").cast("bigint") - 25
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", C.above_zero(x).alias("positive"), C.chart_vital(x, F.col("l_linenumber"), 1).alias("charted"), C.sane(x * 50000.0).alias("sane"), C.within(F.col("l_quantity"), F.lit(10), F.lit(20)).alias("inside"))


@query("""WITH e AS (SELECT l_orderkey AS entity_id, l_linenumber % 3 AS time_ms, CASE l_suppkey % 3 WHEN 0 THEN 203 WHEN 1 THEN 204 ELSE 206 END AS var_id, CASE l_suppkey % 3 WHEN 0 THEN l_quantity * 3 WHEN 1 THEN l_quantity - 5 ELSE l_quantity * 60 - 100 END AS value FROM lineitem),
f AS (SELECT entity_id, time_ms, var_id, CASE var_id WHEN 203 THEN value / 100 ELSE value END AS value FROM e)
SELECT entity_id, CAST(time_ms AS INTEGER) AS time_ms, CAST(var_id AS INTEGER) AS var_id, round(min(value), 6) AS value FROM f WHERE (var_id = 203 AND value >= 0.21 AND value <= 1) OR (var_id = 204 AND value BETWEEN 0 AND 30) OR (var_id = 206 AND value BETWEEN 0 AND 2500) GROUP BY ALL""")
def charted_values(spark, sf):
    """Inspired oxygen from percent, pressure and urine inside their ranges, one a time."""
    k, q = F.col("l_suppkey") % 3, F.col("l_quantity")
    e = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("entity_id"), (F.col("l_linenumber") % 3).cast("int").alias("time_ms"), F.when(k == 0, 203).when(k == 1, 204).otherwise(206).alias("var_id"), F.when(k == 0, q * 3).when(k == 1, q - 5).otherwise(q * 60 - 100).cast("double").alias("value"))
    return actions.charted(e, E1).withColumn("value", F.round("value", 6))


@query(sql("").rstrip() + """,
s AS (SELECT entity_id, time_ms, CASE CAST(entity_id AS BIGINT) % 4 WHEN 0 THEN 6 WHEN 1 THEN 7 WHEN 2 THEN 108 ELSE 5 END AS v, CASE CAST(entity_id AS BIGINT) % 4 WHEN 0 THEN value / 10 WHEN 1 THEN value * 2 WHEN 2 THEN value / 10 ELSE value / 20 END AS x FROM cleaned WHERE var_id = 100)
SELECT entity_id, time_ms, CAST(CASE v WHEN 6 THEN 303 WHEN 7 THEN 302 WHEN 108 THEN 305 ELSE 306 END AS INTEGER) AS var_id, CAST(CASE v
 WHEN 6 THEN CASE WHEN x >= 12 THEN 4 WHEN x >= 6 THEN 3 WHEN x >= 1.2 THEN 2 ELSE 0 END
 WHEN 7 THEN CASE WHEN x < 20 THEN 4 WHEN x < 50 THEN 3 WHEN x < 100 THEN 2 WHEN x < 150 THEN 1 ELSE 0 END
 WHEN 108 THEN CASE WHEN x < 6 THEN 4 WHEN x < 10 THEN 3 WHEN x < 13 THEN 2 WHEN x < 15 THEN 1 ELSE 0 END
 ELSE CASE WHEN x >= 5 THEN 4 WHEN x >= 3.5 THEN 3 WHEN x >= 2 THEN 2 WHEN x >= 1.2 THEN 1 ELSE 0 END END AS DOUBLE) AS value FROM s""")
def organ_scores(spark, sf):
    """Liver, coagulation, nerves and kidneys by their own ladders."""
    k, v = F.col("entity_id").cast("bigint") % 4, F.col("value")
    ev = clean(spark, sf).where("var_id = 100").select("entity_id", "time_ms", F.when(k == 0, 6).when(k == 1, 7).when(k == 2, 108).otherwise(5).alias("var_id"), F.when(k == 0, v / 10).when(k == 1, v * 2).when(k == 2, v / 10).otherwise(v / 20).alias("value"))
    return scores.simple_scores(ev, E1)


def _waves(spark, sf):
    """A signal of one sample an hour whose value is its hour on the axis."""
    hour = F.col("seg_idx") * 24
    return axis(spark, sf).select("entity_id", "seg_idx", "time_ms", F.lit("II").alias("channel"), F.lit(24 / 86_400).alias("fs"), F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: (hour + i).cast("float")).alias("samples"))


@query(_samples_sql("end", 2 * DAY).replace("SELECT entity_id, var_id, label_ms, offset_ms, value, t_start, t_end, seg_lo, seg_hi FROM hi", f"""SELECT entity_id, var_id, label_ms, CAST(48 AS INTEGER) AS n, CAST(seg_lo * 24 + round((t_start - lo_ms) * 24 / {DAY}.0) AS DOUBLE) AS first, CAST(seg_lo * 24 + round((t_start - lo_ms) * 24 / {DAY}.0) + 47 AS DOUBLE) AS last FROM hi""").replace("a.island AS i1 FROM", "a.island AS i1, a.time_ms AS lo_ms FROM"))
def sample_waves(spark, sf):
    """Labels with the two days of signal before them."""
    index = samples.sample_index(clean(spark, sf), axis(spark, sf), E1, [0, 100], 2 * DAY, "end", (5, 150), segment_ms=DAY)
    wave = F.col("waveforms")["II"]
    out = samples.materialise(index, _waves(spark, sf), E1)
    return out.select("entity_id", "var_id", "label_ms", F.size(wave).alias("n"), wave[0].cast("double").alias("first"), F.element_at(wave, -1).cast("double").alias("last"))


@query(_samples_sql("middle", DAY, f"(0), ({6 * HOUR})").replace("SELECT entity_id, var_id, label_ms, offset_ms, value, t_start, t_end, seg_lo, seg_hi FROM hi", "SELECT * FROM hi").replace("\nSELECT * FROM hi", ",\nfit AS (SELECT * FROM hi") + f"""),
t AS (SELECT *, row_number() OVER (PARTITION BY entity_id, var_id ORDER BY label_ms) AS rn FROM (SELECT DISTINCT entity_id, var_id, label_ms FROM fit)),
k AS (WITH RECURSIVE r AS (SELECT entity_id, var_id, label_ms, rn, true AS kept, label_ms AS last FROM t WHERE rn = 1
  UNION ALL SELECT t.entity_id, t.var_id, t.label_ms, t.rn, t.label_ms - r.last >= {DAY}, CASE WHEN t.label_ms - r.last >= {DAY} THEN t.label_ms ELSE r.last END FROM r JOIN t ON t.entity_id = r.entity_id AND t.var_id = r.var_id AND t.rn = r.rn + 1)
  SELECT * FROM r WHERE kept)
SELECT entity_id, var_id, label_ms, offset_ms, value, t_start, t_end, seg_lo, seg_hi FROM fit SEMI JOIN k USING (entity_id, var_id, label_ms)""")
def sample_index_throttled(spark, sf):
    """At most one label a day, whichever of its offsets fit."""
    return samples.sample_index(clean(spark, sf), axis(spark, sf), E1, [0, 100], DAY, "middle", (5, 150), (0, 6 * HOUR), interval_ms=DAY, segment_ms=DAY)


def _seconds(spark, sf):
    size = F.when(F.col("seg_idx") % 7 == 3, 29).otherwise(30)
    return axis(spark, sf).where("NOT (seg_idx = 2 AND entity_id LIKE '%5')").select("entity_id", "seg_idx", "time_ms", F.lit("II").alias("channel"), F.lit(1).alias("fs"), F.array_repeat(F.lit(0.0).cast("float"), size).alias("samples"))


SECONDS = "sec AS (SELECT entity_id, seg_idx, CASE WHEN seg_idx % 7 = 3 THEN 29 ELSE 30 END AS len FROM axis WHERE NOT (seg_idx = 2 AND entity_id LIKE '%5'))"


@query(sql("").rstrip() + f", {SECONDS} SELECT entity_id, seg_idx FROM sec WHERE len <> 30")
def rate_errors(spark, sf):
    return segments.rate_errors(_seconds(spark, sf)).select("entity_id", "seg_idx")


@query(sql("").rstrip() + f""", {SECONDS}, g AS (SELECT entity_id, count(*) FILTER (len <> 30) AS bad, count(*) AS n FROM sec GROUP BY 1),
ev AS (SELECT entity_id, count(*) AS n_events, max(time_ms) FILTER (part = 'events') AS last FROM traj GROUP BY 1)
SELECT b.entity_id, b.n_seg, coalesce(n_events, 0) AS n_events, CAST(CASE WHEN n IS NULL THEN 1 ELSE 0 END + CASE WHEN coalesce(bad, 0) > 0 THEN 1 ELSE 0 END + CASE WHEN coalesce(n, 0) <> b.n_seg THEN 1 ELSE 0 END + CASE WHEN last > wl + {DAY // 2} THEN 1 ELSE 0 END AS INTEGER) AS n_errors FROM bounds b LEFT JOIN g USING (entity_id) LEFT JOIN ev USING (entity_id)""")
def manifest(spark, sf):
    """Entities whose signal lacks a segment or has a short one, or whose events run past it."""
    m = quality.manifest(axis(spark, sf), _seconds(spark, sf), trajectory(spark, sf), E1, ["II"], DAY // 2)
    return m.select("entity_id", "n_seg", F.coalesce("n_events", F.lit(0)).alias("n_events"), F.size("errors").alias("n_errors"))


@query(sql("SELECT entity_id, count(*) FILTER (part = 'future') AS n_future FROM traj GROUP BY 1 HAVING NOT coalesce(bool_or(part = 'future' AND var_id BETWEEN 200 AND 299), false)"))
def without_leaks(spark, sf):
    summary = M.part_summary(trajectory(spark, sf))
    return M.assert_no_leak(summary.where("NOT has_future_actions")).select("entity_id", "n_future")


@query(sql("SELECT entity_id, count(*) FILTER (part = 'future') AS n_future, 'actions' AS leaks FROM traj GROUP BY 1 HAVING bool_or(part = 'future' AND var_id BETWEEN 200 AND 299)"))
def leaking_entities(spark, sf):
    """Entities whose future holds actions; no scores or onsets are among the variables."""
    rows = M.leaking(M.part_summary(trajectory(spark, sf)))
    return rows.select("entity_id", "n_future", F.concat_ws(",", "leaks").alias("leaks"))


@query("SELECT o_orderkey, o_orderkey || ',amt ' || CAST(round_even(o_totalprice, 0) AS BIGINT) || ',' || o_orderstatus AS line FROM orders")
def thousands_commas(spark, sf):
    """Numbers written with a thousands separator between unquoted fields."""
    line = F.concat_ws(",", "o_orderkey", F.concat(F.lit("amt "), F.format_number("o_totalprice", 0)), "o_orderstatus")
    return table(spark, sf, "orders").select("o_orderkey", delimited.without_thousands(line).alias("line"))


def _wave(samples, scale: int):
    """Base64 of 16-bit little-endian numbers; what is under -0.25 becomes the sign for no sample."""
    raw = F.transform(samples, lambda x: F.when(x < -0.25, -32768).otherwise(F.round(x.cast("double") * scale)).cast("bigint"))
    text = F.transform(raw, lambda r: F.lpad(F.hex(F.pmod(r, F.lit(65536))), 4, "0"))
    return F.base64(F.unhex(F.array_join(F.transform(text, lambda h: F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2))), "")))


def _named_value(name: str, value):
    return F.struct(value.cast("string").alias("_VALUE"), F.lit(name).alias("_name"))


@query("""WITH b AS (
  SELECT label AS entity_id, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding FROM embeddings
), t AS (
  SELECT entity_id, CAST(i // 8 * 7 + least(i % 8, 6) AS BIGINT) AS s, CAST(i % 8 = 7 AS INTEGER) AS part, vec_id,
    list_transform(embedding, lambda x: CASE WHEN x < -0.25 THEN NULL ELSE CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT) END) AS x
  FROM b WHERE vec_id % 11 <> 0
), l AS (SELECT entity_id, s, arg_max(x, part) AS x, arg_max(vec_id, part) AS vec_id FROM t GROUP BY ALL),
f AS (SELECT entity_id, min(s) AS first, max(s) AS last FROM l GROUP BY 1),
g AS (SELECT *, (s - first) // 5 AS w, (s - first) % 5 AS p FROM l JOIN f USING (entity_id) WHERE len(list_filter(x, lambda v: v IS NULL)) < 32),
u AS (SELECT *, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM g),
w AS (SELECT entity_id, w, count(DISTINCT p) AS coverage, count(v) AS n, sum(v * (p * 64 + k)) AS total FROM u GROUP BY ALL),
c AS (SELECT entity_id FROM w GROUP BY 1 HAVING count(*) FILTER (coverage = 5) >= 2)
SELECT w.entity_id, 1600000000000 + (first + w.w * 5) * 1000 AS time_ms, CAST(w.coverage AS INTEGER) AS pleth_s, CAST(w.n AS BIGINT) AS pleth_n,
  CAST(w.total AS BIGINT) AS pleth_total
FROM w JOIN c USING (entity_id) JOIN f USING (entity_id)""")
def monitor_files(spark, sf):
    """Monitor XML written and read back: repeated seconds in two files, blocks that weren't polled, windows from the first block."""
    e = table(spark, sf, "embeddings")
    i = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    rows = e.select(F.col("label").alias("entity_id"), "vec_id", i.alias("i"), "embedding")
    second = F.floor(F.col("i") / 8) * 7 + F.least(F.col("i") % 8, F.lit(6))
    when = F.date_format(F.timestamp_millis(1_600_000_000_000 + second * 1000), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def channel(name: str, scale: int, low: float, high: float):
        fields = {"Wave": _wave(F.col("embedding"), scale), "Gain": F.lit(0.001), "Offset": F.lit(0), "Points": F.size("embedding"), "Min": F.lit(low), "Max": F.lit(high)}
        return F.struct(F.lit(name).alias("_name"), F.array(*(_named_value(k, v) for k, v in fields.items())).alias("m"))

    pleth, ecg = channel("PLETH", 1000, -5.0, 5.0), channel("ECG1", 2000, -0.3, 0.4)
    polled = F.when(F.col("vec_id") % 11 != 0, "POLLTIME").otherwise("OTHER")
    m = F.array(F.struct(F.lit("1").alias("_VALUE"), polled.alias("_name")))
    mg = F.when(F.col("vec_id") % 2 == 0, F.array(pleth, ecg)).otherwise(F.array(pleth))
    out = rows.select("entity_id", (F.col("i") % 8 == 7).cast("int").alias("part"), when.alias("_datetime"), F.struct(m.alias("m"), mg.alias("mg")).alias("measurements"))
    at = place(spark, "monitor")
    out.repartition("entity_id", "part").write.format("xml").option("rowTag", "cpc").option("rootTag", "export").partitionBy("entity_id", "part").save(at)
    cpc = monitors.read_monitor_xml(spark, at).withColumn("file", F.col("part"))
    blocks = monitors.monitor_blocks(cpc, keep=("entity_id", "file")).withColumn("block_ms", F.unix_millis(F.to_timestamp("block_time")))
    got = monitor_windows(blocks, "PLETH", {"PLETH": (64, 64), "ECG1": (64, 64)}, 5, 1, 2)
    raw = F.transform("PLETH", lambda x, k: F.when(~F.isnan(x), F.round(x.cast("double") * 1000).cast("bigint") * (k + 1)))
    there = F.filter(raw, lambda x: x.isNotNull())
    total = F.aggregate(there, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return got.select("entity_id", "time_ms", F.col("coverage_PLETH").alias("pleth_s"), F.size(there).cast("bigint").alias("pleth_n"), total.alias("pleth_total"))


@query(
    f"""SELECT w.entity_id, w.var_id, w.label_ms, i.value * 2 + 1 AS value, w.n, w.first / 2 + 1 AS first, w.last / 2 + 1 AS last
FROM ({ORACLES["sample_waves"]}) w JOIN ({_samples_sql("end", 2 * DAY)}) i USING (entity_id, var_id, label_ms)"""
)
def sample_transforms(spark, sf):
    """Labels and signals through functions of the caller's, as columns."""
    index = samples.sample_index(
        clean(spark, sf), axis(spark, sf), E1, [0, 100], 2 * DAY, "end", (5, 150), segment_ms=DAY, label_transform=lambda v: v * 2 + 1
    )

    def halved(waves):
        return F.transform_values(waves, lambda _, samples: F.transform(samples, lambda x: x / 2 + 1))

    out = samples.materialise(index, _waves(spark, sf), E1, waveform_transform=halved)
    wave = F.col("waveforms")["II"]
    ends = [wave[0].cast("double").alias("first"), F.element_at(wave, -1).cast("double").alias("last")]
    return out.select("entity_id", "var_id", "label_ms", "value", F.size(wave).alias("n"), *ends)


@query(ORACLES["add_variables_later"])
def merged_store(spark, sf):
    """Later variables merged into a stored trajectory, twice; only buckets with new events are written."""
    at = place(spark, "store")
    t = trajectory(spark, sf).select("entity_id", "time_ms", "var_id", "value", "seg_idx", "part")
    stores.write_store(t.where("var_id < 200"), at, 16)
    for _ in range(2):
        stores.merge_into(spark, at, t.where("var_id >= 100"), 16)
    return stores.read_store(spark, at).select("entity_id", "time_ms", "var_id", "value", "part")


@query(ORACLES["replace_actions"])
def replaced_in_store(spark, sf):
    """The actions of a store replaced by doubled ones."""
    at = place(spark, "store")
    events = clean(spark, sf)
    stores.write_store(events, at, 16)
    stores.replace_in(spark, at, events.withColumn("value", F.col("value") * 2), 200, 299, 16)
    return stores.read_store(spark, at).select("entity_id", "time_ms", "var_id", F.round("value", 6).alias("value"))


@query(ORACLES["verification_report"] + "\nUNION ALL SELECT 'rows', 'info', count(*), true FROM traj")
def checked_write(spark, sf):
    """A trajectory written with the checks of ``verification_report`` counted on the way."""
    checks = [("value range", "error", F.col("value") < 0), ("late event", "warning", F.col("part") == "future"), ("unknown variable", "error", ~F.col("var_id").isin(0, 100, 101, 200))]
    return stores.write_checked(trajectory(spark, sf), place(spark, "checked"), checks, ("part",))


@query(ORACLES["sample_waves"])
def stored_samples(spark, sf):
    """The samples of ``sample_waves``, cut from a table bucketed by entity and block."""
    name = f"signals_{uuid.uuid4().hex}"
    stores.write_signals(_waves(spark, sf), name, place(spark, "signals"), 16, 64, 3)
    index = samples.sample_index(clean(spark, sf), axis(spark, sf), E1, [0, 100], 2 * DAY, "end", (5, 150), segment_ms=DAY)
    wave = F.col("waveforms")["II"]
    out = stores.cut_samples(index, name, 16, 64, 3)
    return out.select("entity_id", "var_id", "label_ms", F.size(wave).alias("n"), wave[0].cast("double").alias("first"), F.element_at(wave, -1).cast("double").alias("last"))


def _header_folder(spark, sf) -> str:
    """Header files of 32 records: a line per supplier, a comment in between."""
    at = place(spark, "headers")
    s = table(spark, sf, "supplier").withColumns({"subject": F.col("s_suppkey") % 8, "record": F.floor(F.col("s_suppkey") / 8) % 4})
    name = F.when(F.col("s_suppkey") % 3 == 0, "II").when(F.col("s_suppkey") % 3 == 1, "PLETH").otherwise("ABP")
    line = F.concat(F.lit("a.dat 80 1023 8 "), name)
    files = s.groupBy("subject", "record").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("s_suppkey", line.alias("line"))))["line"].alias("lines"))
    first = F.concat(F.lit("r"), F.col("record"), F.lit(" "), F.col("n"), F.lit(" 125/1 "), (F.col("record") + 1) * 1000)
    text = F.concat_ws("\n", first, F.lit("# note"), F.array_join("lines", "\n"))
    files.select("subject", "record", text.alias("value")).repartition("subject", "record").write.partitionBy("subject", "record").text(at)
    return at


@query("""WITH s AS (SELECT s_suppkey % 8 AS subject, (s_suppkey // 8) % 4 AS record, s_suppkey % 3 AS c FROM supplier)
SELECT CAST(subject AS VARCHAR) AS subject, coalesce(sum((record + 1) * 8.0) FILTER (c = 0), 0) AS "seconds_II", coalesce(sum((record + 1) * 8.0) FILTER (c = 1), 0) AS "seconds_PLETH",
  list_sort(list(DISTINCT CASE c WHEN 0 THEN 'II' WHEN 1 THEN 'PLETH' ELSE 'ABP' END)) AS channels FROM s GROUP BY 1""")
def scanned_headers(spark, sf):
    """Header files written and read back: seconds of the wanted channels and all channels per subject."""
    found = headers.read_headers(spark, _header_folder(spark, sf), "*.txt")
    return headers.subject_channels(headers.channels(found), "/subject=([0-9]+)/", ["II", "PLETH"])


@query("""SELECT CAST(subject AS VARCHAR) AS entity_id, count(*) AS n_files, CAST(sum(n_bytes) AS BIGINT) AS n_bytes, CAST(min(record) AS INTEGER) AS first, CAST(max(record) AS INTEGER) AS last FROM (
  SELECT s_suppkey % 8 AS subject, (s_suppkey // 8) % 4 AS record, sum(16 + CASE s_suppkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 5 ELSE 3 END + 1) + 8
    + length('r' || any_value((s_suppkey // 8) % 4) || ' ' || count(*) || ' 125/1 ' || any_value(((s_suppkey // 8) % 4 + 1) * 1000)) AS n_bytes
  FROM supplier GROUP BY 1, 2) GROUP BY 1""")
def scanned_files(spark, sf):
    """Names and lengths of the header files by subject, from a scan of the folder."""
    return headers.file_inventory(spark, _header_folder(spark, sf), "*.txt", "/subject=([0-9]+)/record=([0-9]+)/")
