"""Queries on events: mapping, alignment, parts, coverage, samples."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bedside.functions import clean as C
from bedside.operators import aggregates as A
from bedside.operators import asof, dedup, mapping, quality, rangejoin, samples, segments
from bedside.operators import trajectory as M
from bedside.plans import actions, assembly, cohorts, scores, tasks
from bedside.queries.common import DAY, axis, clean, episodes, query, raw_events, registry, sql, table, trajectory, utc_millis

E1 = ["entity_id"]
HOUR = 3_600_000


@query(sql("SELECT part, count(*) AS n, count(DISTINCT entity_id) AS n_entities, round(sum(value), 4) AS total FROM traj GROUP BY part"))
def trajectory_parts(spark, sf):
    return trajectory(spark, sf).groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("entity_id").alias("n_entities"), F.round(F.sum("value"), 4).alias("total"))


@query(sql("SELECT entity_id, time_ms, var_id, value, part, seg_idx FROM traj"))
def split_events(spark, sf):
    return trajectory(spark, sf).select("entity_id", "time_ms", "var_id", "value", "part", "seg_idx")


@query(sql("SELECT entity_id, time_ms, var_id, value FROM cleaned"))
def clean_events(spark, sf):
    return clean(spark, sf)


@query(sql("SELECT entity_id, time_ms, seg_idx FROM axis"))
def segment_axis(spark, sf):
    return axis(spark, sf).select("entity_id", "time_ms", "seg_idx")


@query(sql(f"""SELECT entity_id, time_ms, seg_idx, CAST(sum(new) OVER (PARTITION BY entity_id ORDER BY time_ms) - 1 AS BIGINT) AS island_id
FROM (SELECT *, CASE WHEN time_ms - lag(time_ms) OVER (PARTITION BY entity_id ORDER BY time_ms) = {DAY} THEN 0 ELSE 1 END AS new FROM axis)"""))
def axis_islands(spark, sf):
    return segments.islands(axis(spark, sf), E1, stride_ms=DAY).select("entity_id", "time_ms", "seg_idx", "island_id")


@query(sql(f"""SELECT entity_id, count(*) AS n_seg, min(time_ms) AS wave_start, max(time_ms) AS wave_end, coalesce(bool_and(step > 0), true) AS increasing, count(*) FILTER (step > 1.5 * {DAY}) AS n_gaps
FROM (SELECT *, time_ms - lag(time_ms) OVER (PARTITION BY entity_id ORDER BY seg_idx) AS step FROM axis) GROUP BY 1"""))
def axis_gaps(spark, sf):
    return segments.axis_report(axis(spark, sf), E1, stride_ms=DAY)


@query(sql("SELECT c.entity_id, c.time_ms, c.var_id, c.value, a.seg_idx FROM cleaned c ASOF LEFT JOIN axis a ON c.entity_id = a.entity_id AND c.time_ms >= a.time_ms"))
def as_of_backward(spark, sf):
    return asof.as_of(clean(spark, sf), axis(spark, sf), E1, "time_ms", ["seg_idx"])


@query(sql("SELECT c.entity_id, c.time_ms, c.seg_idx AS own, a.seg_idx FROM axis c ASOF LEFT JOIN axis a ON c.entity_id = a.entity_id AND c.time_ms > a.time_ms"))
def as_of_strict(spark, sf):
    ax = axis(spark, sf)
    return asof.as_of(ax.withColumnRenamed("seg_idx", "own"), ax, E1, "time_ms", ["seg_idx"], strict=True)


@query(sql("SELECT c.entity_id, c.time_ms, c.var_id, c.value, a.seg_idx FROM cleaned c ASOF LEFT JOIN axis a ON c.entity_id = a.entity_id AND c.time_ms <= a.time_ms"))
def as_of_forward(spark, sf):
    return asof.as_of(clean(spark, sf), axis(spark, sf), E1, "time_ms", ["seg_idx"], forward=True)


NEAREST = f"""p AS (SELECT entity_id, time_ms, value FROM cleaned WHERE var_id = 0), v AS (SELECT entity_id, time_ms, value AS other FROM cleaned WHERE var_id = 100),
n AS (SELECT p.entity_id, p.time_ms, p.value, v.other, v.time_ms - p.time_ms AS delta_ms, row_number() OVER (PARTITION BY p.entity_id, p.time_ms, p.value ORDER BY abs(v.time_ms - p.time_ms), v.time_ms) AS rn
  FROM p LEFT JOIN v ON p.entity_id = v.entity_id AND abs(v.time_ms - p.time_ms) < {4 * HOUR})"""


def _nearest(spark, sf):
    ev = clean(spark, sf)
    p = ev.where("var_id = 0").select("entity_id", "time_ms", "value")
    return asof.nearest(p, ev.where("var_id = 100").select("entity_id", "time_ms", F.col("value").alias("other")), E1, "time_ms", "other", 4 * HOUR)


@query(sql("").rstrip() + f",\n{NEAREST}\nSELECT entity_id, time_ms, value, other, delta_ms FROM n WHERE rn = 1")
def as_of_nearest(spark, sf):
    return _nearest(spark, sf)


@query(sql("").rstrip() + f",\n{NEAREST}\nSELECT 'all' AS cohort, count(delta_ms) AS n, round(median(abs(delta_ms)), 3) AS median_abs, round(quantile_cont(CAST(delta_ms AS DOUBLE), 0.05), 3) AS p05, round(quantile_cont(CAST(delta_ms AS DOUBLE), 0.5), 3) AS p50, round(quantile_cont(CAST(delta_ms AS DOUBLE), 0.95), 3) AS p95 FROM n WHERE rn = 1")
def match_quality(spark, sf):
    out = A.match_quality(_nearest(spark, sf).withColumn("cohort", F.lit("all")), ["cohort"])
    return out.withColumns({c: F.round(c, 3) for c in ("median_abs", "p05", "p50", "p95")})


@query(sql("").rstrip() + f""",
h AS (SELECT 'utc' AS hypothesis, 0 AS shift UNION ALL SELECT 'local', {5 * HOUR}),
p AS (SELECT entity_id, time_ms, value FROM cleaned WHERE var_id = 0), v AS (SELECT entity_id, time_ms AS vt FROM cleaned WHERE var_id = 100),
n AS (SELECT hypothesis, min(abs(vt - time_ms - shift)) AS d FROM p CROSS JOIN h JOIN v ON p.entity_id = v.entity_id AND abs(vt - time_ms - shift) < {4 * HOUR} GROUP BY hypothesis, p.entity_id, time_ms, value),
q AS (SELECT hypothesis, median(d) AS median_abs FROM n GROUP BY 1)
SELECT arg_min(hypothesis, (median_abs, hypothesis)) AS hypothesis, min(median_abs) AS median_abs FROM q""")
def time_base_check(spark, sf):
    ev = clean(spark, sf)
    p, v = ev.where("var_id = 0").select("entity_id", "time_ms", "value"), ev.where("var_id = 100").select("entity_id", "time_ms", F.col("value").alias("other"))
    tried = None
    for name, shift in (("utc", 0), ("local", 5 * HOUR)):
        found = asof.nearest(p.withColumn("time_ms", F.col("time_ms") + shift), v, E1, "time_ms", "other", 4 * HOUR).withColumn("hypothesis", F.lit(name))
        tried = found if tried is None else tried.unionByName(found)
    return A.better_hypothesis(A.match_quality(tried.where("delta_ms IS NOT NULL"), ["hypothesis"]))


@query(sql("SELECT entity_id, part, var_id, count(*) AS n FROM traj GROUP BY ALL"))
def event_counts(spark, sf):
    return A.event_counts(trajectory(spark, sf), E1)


COUNTS = "cnt AS (SELECT entity_id, part, var_id, count(*) AS n FROM traj GROUP BY ALL)"


@query(sql("").rstrip() + f""",
{COUNTS}, tot AS (SELECT count(DISTINCT entity_id) AS t FROM axis)
SELECT var_id, count(*) FILTER (part = 'events' AND n >= 1) AS eligible_1, count(*) FILTER (part = 'events' AND n >= 3) AS eligible_3, count(*) FILTER (part = 'events' AND n >= 5) AS eligible_5,
 round(count(*) FILTER (part = 'events' AND n >= 1) / max(t), 4) AS share_1, round(count(*) FILTER (part = 'events' AND n >= 3) / max(t), 4) AS share_3, round(count(*) FILTER (part = 'events' AND n >= 5) / max(t), 4) AS share_5,
 CAST(floor(coalesce(quantile_cont(CAST(n AS DOUBLE), 0.5) FILTER (part = 'events'), 0)) AS BIGINT) AS median_events, CAST(floor(coalesce(quantile_cont(CAST(n AS DOUBLE), 0.95) FILTER (part = 'events'), 0)) AS BIGINT) AS p95_events,
 CAST(coalesce(sum(n) FILTER (part = 'events'), 0) AS BIGINT) AS total_events, count(*) FILTER (part = 'recent') AS any_recent, count(*) FILTER (part = 'baseline') AS any_baseline,
 CAST(floor(coalesce(quantile_cont(CAST(n AS DOUBLE), 0.5) FILTER (part = 'recent'), 0)) AS BIGINT) AS median_recent, CAST(floor(coalesce(quantile_cont(CAST(n AS DOUBLE), 0.5) FILTER (part = 'baseline'), 0)) AS BIGINT) AS median_baseline
FROM cnt, tot GROUP BY var_id""")
def coverage(spark, sf):
    n = axis(spark, sf).select("entity_id").distinct().count()
    return A.coverage(A.event_counts(trajectory(spark, sf), E1), n)


@query(sql("""SELECT entity_id, count(*) FILTER (part = 'baseline') AS n_baseline, count(*) FILTER (part = 'recent') AS n_recent, count(*) FILTER (part = 'events') AS n_events, count(*) FILTER (part = 'future') AS n_future,
 count(DISTINCT var_id) FILTER (part = 'events') AS vars_events, count(DISTINCT var_id) FILTER (part = 'future') AS vars_future,
 coalesce(bool_or(part = 'future' AND var_id BETWEEN 200 AND 299), false) AS has_future_actions, coalesce(bool_or(part = 'future' AND var_id = 303), false) AS has_future_scores, coalesce(bool_or(part = 'future' AND var_id = 307), false) AS has_future_onset
 FROM (SELECT entity_id, part, CASE var_id WHEN 101 THEN 303 WHEN 0 THEN 307 ELSE var_id END AS var_id FROM traj) GROUP BY 1"""))
def part_summary(spark, sf):
    scored = mapping.renumber(mapping.renumber(trajectory(spark, sf), 101, 303), 0, 307)
    return M.part_summary(scored)


@query(sql("SELECT entity_id, part, 0 AS n_errors FROM traj GROUP BY ALL").replace("0 AS n_errors", "CAST(0 AS INTEGER) AS n_errors"))
def validate_parts(spark, sf):
    return M.validate_parts(trajectory(spark, sf), axis(spark, sf)).select("entity_id", "part", F.size("errors").alias("n_errors"))


@query(sql(f"SELECT t.entity_id, t.time_ms, t.var_id, t.value, t.time_ms < a.time_ms + {DAY} AS in_segment FROM traj t JOIN axis a USING (entity_id, seg_idx) WHERE part = 'events'"))
def events_in_gaps(spark, sf):
    t = trajectory(spark, sf).where("part = 'events'").select("entity_id", "time_ms", "var_id", "value", "seg_idx")
    return M.in_segment(t, axis(spark, sf), E1, DAY).drop("seg_idx")


@query(sql("SELECT entity_id, var_id, arg_max(value, (time_ms, value)) AS last_value, max(time_ms) AS last_ms FROM traj WHERE part = 'recent' GROUP BY ALL"))
def recent_state(spark, sf):
    return M.last_values(trajectory(spark, sf), E1)


@query(sql("SELECT entity_id, var_id, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM traj WHERE part = 'baseline' GROUP BY ALL"))
def baseline_stats(spark, sf):
    return M.baseline_stats(trajectory(spark, sf), E1).withColumn("mean", F.round("mean", 6))


@query(sql("SELECT entity_id, time_ms, var_id, value, part FROM traj"))
def add_variables_later(spark, sf):
    ev, ax, ep = clean(spark, sf), axis(spark, sf), episodes(spark, sf)
    first = M.split_events(ev.where("var_id < 200"), ax, ep, pad_ms=DAY).select("entity_id", "time_ms", "var_id", "value", "seg_idx", "part")
    return M.add_events(first, ev.where("var_id >= 100"), ax, ep, pad_ms=DAY).select("entity_id", "time_ms", "var_id", "value", "part")


@query(sql("SELECT entity_id, time_ms, var_id, value, part FROM traj"))
def whole_trajectory(spark, sf):
    return M.whole_trajectory(trajectory(spark, sf), E1).select("entity_id", "time_ms", "var_id", "value", "part")


@query(sql("SELECT count(*) AS n_events, CAST(0 AS BIGINT) AS n_in_two_parts FROM traj"))
def parts_disjoint(spark, sf):
    t = trajectory(spark, sf)
    return t.agg(F.count("*").alias("n_events")).join(quality.in_two_parts(t, E1).agg(F.count("*").alias("n_in_two_parts")))


@query(sql("""SELECT 'value range' AS "check", 'error' AS severity, count(*) FILTER (value < 0) AS n_bad, count(*) FILTER (value < 0) = 0 AS passed FROM traj
UNION ALL SELECT 'late event', 'warning', count(*) FILTER (part = 'future'), count(*) FILTER (part = 'future') = 0 FROM traj
UNION ALL SELECT 'unknown variable', 'error', count(*) FILTER (var_id NOT IN (0, 100, 101, 200)), count(*) FILTER (var_id NOT IN (0, 100, 101, 200)) = 0 FROM traj"""))
def verification_report(spark, sf):
    checks = [("value range", "error", F.col("value") < 0), ("late event", "warning", F.col("part") == "future"), ("unknown variable", "error", ~F.col("var_id").isin(0, 100, 101, 200))]
    return quality.report(trajectory(spark, sf), checks)


@query(sql("SELECT var_id, count(value) AS n, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.99), 6) AS p99 FROM cleaned GROUP BY 1"))
def norm_stats(spark, sf):
    return A.norm_stats(clean(spark, sf)).withColumns({c: F.round(c, 6) for c in ("mean", "std", "p01", "median", "p99")})


@query(sql("""SELECT c.entity_id, c.time_ms, c.var_id, round(least(greatest((c.value - s.lo) / (s.hi - s.lo + 1e-8), 0), 1), 8) AS scaled
FROM cleaned c JOIN (SELECT var_id, min(value) AS lo, max(value) AS hi FROM cleaned GROUP BY 1) s USING (var_id)"""))
def min_max_scale(spark, sf):
    ev = clean(spark, sf)
    s = A.norm_stats(ev).select("var_id", "low", "high")
    return ev.join(mapping.registry_side(s), "var_id").select("entity_id", "time_ms", "var_id", F.round(C.min_max(F.col("value"), F.col("low"), F.col("high")), 8).alias("scaled"))


@query("SELECT event_type, count(*) AS count FROM events WHERE event_type = 'purchase' GROUP BY 1")
def unknown_codes(spark, sf):
    raw, reg = raw_events(spark, sf), registry(spark)
    return mapping.map_aliases(raw, reg, reg.select("event_type").limit(0), "event_type")[1]


@query("SELECT count(*) FILTER (event_type = 'error') AS n_old, count(*) FILTER (event_type = 'click') AS n_new, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type <> 'purchase'")
def renumber_report(spark, sf):
    ev = mapping.map_codes(raw_events(spark, sf), registry(spark), ["event_type"])
    return mapping.renumber_report(ev, 200, 0)


@query(sql("SELECT CASE var_id WHEN 200 THEN 207 ELSE var_id END AS var_id, count(*) AS n FROM cleaned GROUP BY 1"))
def renumber(spark, sf):
    return mapping.renumber(mapping.renumber(clean(spark, sf), 200, 207), 200, 207).groupBy("var_id").agg(F.count("*").alias("n"))


@query(sql("SELECT entity_id, time_ms, var_id, value FROM (SELECT DISTINCT entity_id, time_ms, var_id, value FROM cleaned)"))
def merge_events(spark, sf):
    ev = clean(spark, sf)
    return dedup.merge_events(ev.where("var_id <= 100"), ev)


@query(sql("SELECT entity_id, time_ms, var_id, CASE WHEN var_id BETWEEN 200 AND 299 THEN round(value * 2, 6) ELSE round(value, 6) END AS value FROM cleaned"))
def replace_actions(spark, sf):
    ev = clean(spark, sf)
    return dedup.replace_band(ev, ev.withColumn("value", F.col("value") * 2), 200, 299).withColumn("value", F.round("value", 6))


@query(sql("SELECT CASE WHEN var_id BETWEEN 0 AND 99 THEN 'lab' WHEN var_id BETWEEN 100 AND 199 THEN 'vital' ELSE 'action' END AS category, count(*) AS n FROM cleaned GROUP BY 1"))
def category_bands(spark, sf):
    ev = clean(spark, sf)
    name = F.when(C.band(F.col("var_id"), "lab"), "lab").when(C.band(F.col("var_id"), "vital"), "vital").when(C.band(F.col("var_id"), "action"), "action")
    return ev.groupBy(name.alias("category")).agg(F.count("*").alias("n"))


@query(sql("SELECT entity_id, count(*) AS n, count(DISTINCT var_id) AS n_vars, round(sum(value), 4) AS total, min(time_ms) AS first_ms, max(time_ms) AS last_ms FROM cleaned GROUP BY 1"))
def entity_profile(spark, sf):
    return clean(spark, sf).groupBy("entity_id").agg(F.count("*").alias("n"), F.count_distinct("var_id").alias("n_vars"), F.round(F.sum("value"), 4).alias("total"), F.min("time_ms").alias("first_ms"), F.max("time_ms").alias("last_ms"))


@query(sql("SELECT entity_id, var_id, count(*) AS n, min(value) AS low, max(value) AS high, round(quantile_cont(value, 0.5), 6) AS median FROM cleaned GROUP BY ALL"))
def variable_table(spark, sf):
    return clean(spark, sf).groupBy("entity_id", "var_id").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.median("value"), 6).alias("median"))


@query(sql("SELECT n_vars, count(*) AS n_entities FROM (SELECT entity_id, count(DISTINCT var_id) AS n_vars FROM cleaned GROUP BY 1) GROUP BY 1"))
def variable_histogram(spark, sf):
    return A.histogram_of_counts(clean(spark, sf), "entity_id", "var_id")


@query(sql("""SELECT var_id, count(*) AS n_entities, median(m) AS median_step, min(m) AS least_step, max(m) AS greatest_step FROM (
 SELECT entity_id, var_id, count(*) AS k, median(d) FILTER (d > 0) AS m FROM (SELECT entity_id, var_id, time_ms - lag(time_ms) OVER w AS d, row_number() OVER w AS rn FROM cleaned WINDOW w AS (PARTITION BY entity_id, var_id ORDER BY time_ms)) WHERE rn <= 2000 GROUP BY 1, 2) WHERE k >= 3 AND m IS NOT NULL GROUP BY 1"""))
def sampling_cadence(spark, sf):
    return A.cadence(clean(spark, sf), "var_id", E1, "time_ms")


@query(sql("SELECT entity_id, time_ms, value FROM (SELECT *, lag(value) OVER (PARTITION BY entity_id ORDER BY time_ms) AS b FROM cleaned WHERE var_id = 100 AND value <= 100) WHERE b IS NULL OR abs(value - b) > 20"))
def step_changes(spark, sf):
    held = F.when(F.col("value") > 100, float("nan")).otherwise(F.col("value"))
    rows = clean(spark, sf).where("var_id = 100").select("entity_id", "time_ms", held.alias("value"))
    return segments.step_changes(rows, E1, "time_ms", "value", 20)


def _samples_sql(alignment: str, window: int, offsets: str = "(0)") -> str:
    before = {"end": window, "middle": window // 2, "start": 0}[alignment]
    return sql("").rstrip() + f""",
isl AS (SELECT *, sum(new) OVER (PARTITION BY entity_id ORDER BY time_ms) AS island FROM (SELECT *, CASE WHEN time_ms - lag(time_ms) OVER (PARTITION BY entity_id ORDER BY time_ms) = {DAY} THEN 0 ELSE 1 END AS new FROM axis)),
lab AS (SELECT entity_id, var_id, time_ms AS label_ms, CAST(o AS BIGINT) AS offset_ms, value, time_ms + o - {before} AS t_start, time_ms + o - {before} + {window} AS t_end FROM cleaned, (VALUES {offsets}) AS v(o) WHERE var_id IN (0, 100) AND value BETWEEN 5 AND 150),
lo AS (SELECT l.*, a.seg_idx AS seg_lo, a.island AS i1 FROM lab l ASOF JOIN isl a ON l.entity_id = a.entity_id AND l.t_start >= a.time_ms),
hi AS (SELECT l.*, a.seg_idx AS seg_hi, a.island AS i2, a.time_ms AS last_ms FROM lo l ASOF JOIN isl a ON l.entity_id = a.entity_id AND l.t_end > a.time_ms)
SELECT entity_id, var_id, label_ms, offset_ms, value, t_start, t_end, seg_lo, seg_hi FROM hi WHERE i1 = i2 AND last_ms + {DAY} >= t_end AND seg_lo <= seg_hi"""


@query(_samples_sql("end", 2 * DAY))
def sample_index_end(spark, sf):
    return samples.sample_index(clean(spark, sf), axis(spark, sf), E1, [0, 100], 2 * DAY, "end", (5, 150), segment_ms=DAY)


@query(_samples_sql("middle", DAY + 7, f"(0), ({-6 * HOUR}), ({6 * HOUR})"))
def sample_index_middle(spark, sf):
    return samples.sample_index(clean(spark, sf), axis(spark, sf), E1, [0, 100], DAY + 7, "middle", (5, 150), (0, -6 * HOUR, 6 * HOUR), segment_ms=DAY)


@query(_samples_sql("start", DAY))
def sample_index_start(spark, sf):
    return samples.sample_index(clean(spark, sf), axis(spark, sf), E1, [0, 100], DAY, "start", (5, 150), segment_ms=DAY)


@query(sql("").rstrip() + f""",
d AS (SELECT entity_id, var_id // 100 AS var_id, time_ms // {6 * HOUR} * {6 * HOUR} AS time_ms, value FROM cleaned),
t AS (SELECT entity_id, var_id, time_ms, row_number() OVER (PARTITION BY entity_id, var_id ORDER BY time_ms) AS rn FROM (SELECT DISTINCT entity_id, var_id, time_ms FROM d)),
k AS (WITH RECURSIVE r AS (SELECT entity_id, var_id, time_ms, rn, true AS kept, time_ms AS last FROM t WHERE rn = 1
  UNION ALL SELECT t.entity_id, t.var_id, t.time_ms, t.rn, t.time_ms - r.last >= {2 * DAY}, CASE WHEN t.time_ms - r.last >= {2 * DAY} THEN t.time_ms ELSE r.last END FROM r JOIN t ON t.entity_id = r.entity_id AND t.var_id = r.var_id AND t.rn = r.rn + 1)
  SELECT * FROM r WHERE kept)
SELECT d.entity_id, d.time_ms, d.var_id, min(d.value) AS value FROM d SEMI JOIN k ON d.entity_id = k.entity_id AND d.var_id = k.var_id AND d.time_ms = k.time_ms GROUP BY ALL""")
def throttle_labels(spark, sf):
    at, var = F.floor(F.col("time_ms") / (6 * HOUR)) * (6 * HOUR), F.floor(F.col("var_id") / 100)
    labels = clean(spark, sf).withColumns({"time_ms": at, "var_id": var})  # many labels at one time
    return samples.throttle(labels, ["entity_id", "var_id"], "time_ms", F.lit(True), 2 * DAY, ["value"]).select("entity_id", "time_ms", "var_id", "value")


@query(
    """WITH RECURSIVE e AS (SELECT DISTINCT event_type, epoch_us(ts) // 1000 AS t FROM events WHERE value > 1),
n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY t) AS i FROM e),
r AS (
  SELECT event_type, t, i, true AS kept, t AS last FROM n WHERE i = 1
  UNION ALL
  SELECT n.event_type, n.t, n.i, n.t - r.last >= 3600000, CASE WHEN n.t - r.last >= 3600000 THEN n.t ELSE r.last END
  FROM r JOIN n ON n.event_type = r.event_type AND n.i = r.i + 1
)
SELECT event_type, t AS time_ms FROM r WHERE kept"""
)
def throttle_common_keys(spark, sf):
    """Four keys hold all events: at most one an hour of each."""
    labels = table(spark, sf, "events").select("event_type", "value", utc_millis("ts").alias("time_ms"))
    kept = samples.throttle(labels, ["event_type"], "time_ms", F.col("value") > 1, HOUR, ["value"])
    return kept.select("event_type", "time_ms")


@query(sql(f"""SELECT 'early' AS dataset, var_id, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM cleaned WHERE time_ms < 1705363200000 GROUP BY var_id
UNION ALL SELECT 'late', var_id, count(*), round(avg(value), 6), min(value), max(value) FROM cleaned WHERE time_ms >= 1705363200000 GROUP BY var_id"""))
def concat_cohorts(spark, sf):
    ev = clean(spark, sf)
    both = samples.concat_cohorts({"early": ev.where("time_ms < 1705363200000"), "late": ev.where("time_ms >= 1705363200000")})
    return samples.sample_stats(both, ["dataset", "var_id"]).withColumn("mean", F.round("mean", 6))


@query(sql("").rstrip() + f""",
cells AS (SELECT a.entity_id, a.seg_idx, v.var_id FROM axis a, (VALUES (0), (100)) AS v(var_id)),
m AS (SELECT entity_id, seg_idx, var_id, arg_max(value, time_ms) AS x FROM traj WHERE part = 'events' AND var_id IN (0, 100) GROUP BY ALL),
g AS (SELECT c.*, m.x FROM cells c LEFT JOIN m USING (entity_id, seg_idx, var_id)),
w AS (SELECT *, last_value(CASE WHEN x IS NOT NULL THEN seg_idx END IGNORE NULLS) OVER b AS i1, last_value(x IGNORE NULLS) OVER b AS x1, first_value(CASE WHEN x IS NOT NULL THEN seg_idx END IGNORE NULLS) OVER f AS i2, first_value(x IGNORE NULLS) OVER f AS x2 FROM g
  WINDOW b AS (PARTITION BY entity_id, var_id ORDER BY seg_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY entity_id, var_id ORDER BY seg_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT entity_id, seg_idx, var_id, CAST(CASE WHEN x IS NOT NULL THEN 2 WHEN i1 IS NOT NULL AND i2 IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS mask,
 round(CASE WHEN x IS NOT NULL THEN x WHEN i1 IS NOT NULL AND i2 IS NOT NULL THEN x1 + (x2 - x1) * (seg_idx - i1) / (i2 - i1) END, 6) AS value FROM w""")
def dense_grid(spark, sf):
    inside = trajectory(spark, sf).where("part = 'events'")
    return segments.dense_grid(axis(spark, sf), inside.where("var_id IN (0, 100)"), E1, [0, 100]).withColumn("value", F.round("value", 6))


@query(sql("SELECT entity_id, unnest(range(0, n - 1, 2)) AS first FROM (SELECT entity_id, count(*) AS n FROM axis GROUP BY 1) WHERE n >= 2"))
def sliding_index(spark, sf):
    n = axis(spark, sf).groupBy("entity_id").agg(F.count("*").alias("n"))
    return segments.sliding_index(n, E1, "n", 2, 2)


@query(sql("SELECT entity_id, time_ms, var_id FROM traj WHERE part = 'events' AND seg_idx >= 1 AND seg_idx < 4"))
def events_in_segments(spark, sf):
    return segments.events_in_segments(trajectory(spark, sf).where("part = 'events'"), 1, 4).select("entity_id", "time_ms", "var_id")


def _task_sql(having: str) -> str:
    return sql("").rstrip() + f", {COUNTS}\nSELECT entity_id FROM cnt WHERE part = 'events' AND var_id IN (0, 100, 200) GROUP BY 1 HAVING {having}"


def _task(spark, sf, spec):
    t = trajectory(spark, sf)
    return tasks.build_task(A.event_counts(t, E1), axis(spark, sf).select("entity_id").distinct(), spec, E1)


@query(_task_sql("count(*) FILTER (n >= 4) >= 1"))
def task_any(spark, sf):
    return _task(spark, sf, tasks.TaskSpec("any", (0, 100, 200), 4, "any"))


@query(_task_sql("count(*) FILTER (n >= 4) = 3"))
def task_all(spark, sf):
    return _task(spark, sf, tasks.TaskSpec("all", (0, 100, 200), 4, "all"))


@query(sql("").rstrip() + f", {COUNTS}\nSELECT entity_id, var_id FROM cnt WHERE part = 'events' AND var_id IN (0, 100, 200) AND n >= 4")
def task_per_target(spark, sf):
    return _task(spark, sf, tasks.TaskSpec("each", (0, 100, 200), 4, "per_target"))


@query(sql("").rstrip() + f""", {COUNTS}, sp AS (SELECT DISTINCT entity_id, CASE WHEN CAST(entity_id AS BIGINT) % 10 < 7 THEN 'train' ELSE 'test' END AS split FROM cnt),
x AS (SELECT split, var_id, n FROM cnt JOIN sp USING (entity_id) WHERE part = 'events')
SELECT split, var_id, count(*) FILTER (n >= 2) AS eligible FROM x GROUP BY ALL UNION ALL SELECT 'all', var_id, count(*) FILTER (n >= 2) FROM x GROUP BY var_id""")
def split_coverage(spark, sf):
    counts = A.event_counts(trajectory(spark, sf), E1)
    sp = counts.select("entity_id").distinct().withColumn("split", F.when(F.col("entity_id").cast("long") % 10 < 7, "train").otherwise("test"))
    return A.split_coverage(counts, sp, E1, 2)


SCORE_EVENTS = "s AS (SELECT entity_id, time_ms, CASE var_id WHEN 0 THEN 14 WHEN 100 THEN 106 WHEN 101 THEN 7 WHEN 200 THEN 203 END AS var_id, CASE var_id WHEN 200 THEN value / 300 ELSE value END AS value FROM cleaned)"


def _score_events(spark, sf):
    var = F.when(F.col("var_id") == 0, 14).when(F.col("var_id") == 100, 106).when(F.col("var_id") == 101, 7).when(F.col("var_id") == 200, 203)
    return clean(spark, sf).select("entity_id", "time_ms", var.alias("var_id"), F.when(F.col("var_id") == 200, F.col("value") / 300).otherwise(F.col("value")).alias("value"))


@query(sql("").rstrip() + f""",
{SCORE_EVENTS}, p AS (SELECT * FROM s WHERE var_id = 14), f AS (SELECT * FROM s WHERE var_id = 203),
n AS (SELECT p.entity_id, p.time_ms, p.value, f.value AS fio2, row_number() OVER (PARTITION BY p.entity_id, p.time_ms, p.value ORDER BY abs(f.time_ms - p.time_ms), f.time_ms) AS rn FROM p LEFT JOIN f ON p.entity_id = f.entity_id AND abs(f.time_ms - p.time_ms) < {4 * HOUR})
SELECT entity_id, time_ms, 301 AS var_id, CAST(CASE WHEN r < 100 THEN 4 WHEN r < 200 THEN 3 WHEN r < 300 THEN 2 WHEN r < 400 THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM (SELECT *, value / coalesce(fio2, 0.21) AS r FROM n WHERE rn = 1 AND coalesce(fio2, 0.21) > 0)""")
def resp_score(spark, sf):
    return scores.resp_scores(_score_events(spark, sf), E1)


@query(sql("").rstrip() + f""",
{SCORE_EVENTS} SELECT entity_id, time_ms, 302 AS var_id, CAST(CASE WHEN value < 20 THEN 4 WHEN value < 50 THEN 3 WHEN value < 100 THEN 2 WHEN value < 150 THEN 1 ELSE 0 END AS DOUBLE) AS value FROM s WHERE var_id = 7""")
def coag_score(spark, sf):
    return scores.simple_scores(_score_events(spark, sf), E1)


@query(sql("").rstrip() + f""",
m AS (SELECT entity_id, time_ms, value AS map FROM cleaned WHERE var_id = 100), d AS (SELECT entity_id, time_ms, value / 1000 AS ne FROM cleaned WHERE var_id = 200),
n AS (SELECT m.entity_id, m.time_ms, m.map, coalesce(max(ne), 0) AS ne FROM m LEFT JOIN d ON m.entity_id = d.entity_id AND abs(d.time_ms - m.time_ms) < {HOUR} GROUP BY ALL)
SELECT entity_id, time_ms, 304 AS var_id, CAST(CASE WHEN ne > 0.1 THEN 4 WHEN ne > 0 THEN 3 WHEN map < 70 THEN 1 ELSE 0 END AS DOUBLE) AS value FROM n""")
def cardio_score(spark, sf):
    var = F.when(F.col("var_id") == 100, 106).when(F.col("var_id") == 200, 200)
    ev = clean(spark, sf).where("var_id IN (100, 200)").select("entity_id", "time_ms", var.alias("var_id"), F.when(F.col("var_id") == 200, F.col("value") / 1000).otherwise(F.col("value")).alias("value"))
    return scores.cardio_scores(ev, E1)


@query(sql("").rstrip() + f""",
sc AS (SELECT entity_id, time_ms, var_id, value FROM cleaned WHERE var_id = 101 UNION ALL SELECT entity_id, min(time_ms), 307, 1.0 FROM cleaned WHERE var_id = 200 AND value > 100 GROUP BY 1)
SELECT sc.entity_id, sc.time_ms, sc.var_id, sc.value, a.seg_idx FROM sc ASOF JOIN axis a ON sc.entity_id = a.entity_id AND sc.time_ms >= a.time_ms""")
def task_events(spark, sf):
    ev = clean(spark, sf)
    onset = ev.where("var_id = 200 AND value > 100").groupBy("entity_id").agg(F.min("time_ms").alias("onset_ms"))
    return scores.task_events(ev.where("var_id = 101"), onset, axis(spark, sf), E1)


COHORT = f"""co AS (SELECT b.entity_id, ws AS start_ms, wl + {DAY} AS end_ms FROM bounds b), onset AS (SELECT entity_id, min(time_ms) AS onset_ms FROM cleaned WHERE var_id = 200 AND value > 150 GROUP BY 1)"""


@query(sql("").rstrip() + f""", {COHORT}
SELECT entity_id, start_ms, end_ms, onset_ms, onset_ms IS NOT NULL AS is_case, CASE WHEN onset_ms IS NULL THEN 'none' WHEN onset_ms < start_ms THEN 'before' WHEN onset_ms > end_ms THEN 'after' ELSE 'during' END AS position FROM co LEFT JOIN onset USING (entity_id)""")
def onset_cohort(spark, sf):
    co = M.axis_bounds(axis(spark, sf), E1).select("entity_id", F.col("wave_start").alias("start_ms"), (F.col("wave_last") + DAY).alias("end_ms"))
    onset = clean(spark, sf).where("var_id = 200 AND value > 150").groupBy("entity_id").agg(F.min("time_ms").alias("onset_ms"))
    return cohorts.onset_cohort(co, onset, "entity_id")


@query(sql("SELECT DISTINCT entity_id, time_ms, 205 AS var_id, CAST(1.0 AS DOUBLE) AS value FROM cleaned WHERE (var_id = 100 AND value > 21) OR (var_id = 101 AND value > 50)"))
def ventilation(spark, sf):
    var = F.when(F.col("var_id") == 100, 203).when(F.col("var_id") == 101, 204)
    ev = clean(spark, sf).where("var_id IN (100, 101)").select("entity_id", "time_ms", var.alias("var_id"), F.when(F.col("var_id") == 100, F.col("value") / 100).otherwise(F.col("value") - 50).alias("value"))
    return actions.ventilation(ev, E1)


@query(sql(f"SELECT n.entity_id FROM (SELECT DISTINCT entity_id FROM raw) n ANTI JOIN (SELECT entity_id FROM bounds WHERE n_seg >= 4) d USING (entity_id)"))
def not_yet_done(spark, sf):
    done = M.axis_bounds(axis(spark, sf), E1).select("entity_id", F.when(F.col("n_seg") >= 4, 2).otherwise(1).alias("layout_version"))
    return assembly.not_yet_done(raw_events(spark, sf).select("entity_id").distinct(), done, 2)


@query(sql("SELECT count(*) FILTER (a.e IS NOT NULL AND b.e IS NOT NULL) AS n_both, count(*) FILTER (a.e IS NOT NULL AND b.e IS NULL) AS n_left, count(*) FILTER (a.e IS NULL AND b.e IS NOT NULL) AS n_right, count(*) FILTER (a.e IS NULL AND b.e IS NULL) AS n_neither FROM (SELECT DISTINCT entity_id FROM raw) u LEFT JOIN (SELECT DISTINCT entity_id AS e FROM cleaned WHERE var_id = 0 AND value > 150) a ON u.entity_id = a.e LEFT JOIN (SELECT DISTINCT entity_id AS e FROM cleaned WHERE var_id = 100 AND value > 150) b ON u.entity_id = b.e"))
def overlap_census(spark, sf):
    ev = clean(spark, sf)
    return rangejoin.overlap_census(ev.where("var_id = 0 AND value > 150"), ev.where("var_id = 100 AND value > 150"), raw_events(spark, sf), "entity_id")


@query(sql("SELECT part AS status, count(*) AS n FROM traj GROUP BY 1"))
def run_summary(spark, sf):
    from bedside.sources.sinks import run_summary as summary

    return summary(trajectory(spark, sf), "part")


@query(sql("SELECT entity_id, CAST(sum(n) AS BIGINT) AS n_events, string_agg(part || '=' || n, ',' ORDER BY part) AS parts FROM (SELECT entity_id, part, count(*) AS n FROM traj GROUP BY ALL) GROUP BY 1"))
def entity_meta(spark, sf):
    from bedside.sources.sinks import entity_meta as meta

    entries = F.array_sort(F.transform(F.map_entries("n_by_part"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return meta(trajectory(spark, sf), E1, 2).select("entity_id", "n_events", F.array_join(entries, ",").alias("parts"))


@query(sql("SELECT entity_id, time_ms, var_id, value FROM cleaned WHERE value > 0 AND NOT (var_id = 101 AND value = 0) AND value BETWEEN 10 AND 90"))
def value_filters(spark, sf):
    ev = clean(spark, sf)
    v = F.col("value")
    return ev.where(C.above_zero(v) & C.chart_vital(v, F.col("var_id")) & C.sane(v) & C.label_clip(v, 10, 90) & C.finite(v))


@query(sql("SELECT count(*) AS n_entities, CAST(sum(n_seg) AS BIGINT) AS n_segments, CAST(sum(n_seg) * 24 AS BIGINT) AS hours FROM bounds"))
def totals(spark, sf):
    return M.axis_bounds(axis(spark, sf), E1).agg(F.count("*").alias("n_entities"), F.sum("n_seg").alias("n_segments"), (F.sum("n_seg") * 24).alias("hours"))


@query(sql("SELECT entity_id, time_ms, var_id, value FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY time_ms DESC, var_id, value) AS rn FROM cleaned) WHERE rn <= 3"))
def latest_events(spark, sf):
    w = Window.partitionBy("entity_id").orderBy(F.desc("time_ms"), "var_id", "value")
    return clean(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 3").drop("rn")


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50 GROUP BY 1")
def json_props(spark, sf):
    ev = table(spark, sf, "events")
    return ev.where(F.get_json_object("props", "$.k").try_cast("bigint") >= 50).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


TASK_PARTS = f"""te AS (SELECT entity_id, time_ms, var_id, value FROM cleaned WHERE var_id = 101 UNION ALL SELECT entity_id, max(time_ms), 307, 1.0 FROM cleaned WHERE var_id = 200 GROUP BY 1),
tp AS (SELECT te.*, CASE WHEN time_ms BETWEEN ws AND wl THEN 'events' WHEN time_ms >= ws - {DAY} AND time_ms < ws THEN 'recent' WHEN time_ms >= ws - {30 * DAY} AND time_ms < ws - {DAY} THEN 'baseline' WHEN time_ms > wl AND time_ms <= wl + {7 * DAY} THEN 'future' END AS part FROM te JOIN bounds USING (entity_id))"""


@query(sql("").rstrip() + f""", {TASK_PARTS}
SELECT entity_id, count(*) FILTER (part = 'events') AS n_events, count(*) FILTER (part = 'future') AS n_future, coalesce(bool_or(part = 'future' AND var_id = 307), false) AS has_future_onset FROM tp WHERE part IS NOT NULL GROUP BY 1""")
def task_trajectory(spark, sf):
    ev = clean(spark, sf)
    onset = ev.where("var_id = 200").groupBy("entity_id").agg(F.max("time_ms").alias("time_ms")).select("entity_id", "time_ms", F.lit(307).alias("var_id"), F.lit(1.0).alias("value"))
    _, flags = scores.task_trajectory(ev.where("var_id = 101").unionByName(onset), axis(spark, sf), None, E1)
    return flags.select("entity_id", "n_events", "n_future", "has_future_onset")
