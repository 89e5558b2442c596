"""How the given tables stand in for clinical ones, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside.operators.segments import number_segments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DAY = 86_400_000


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its oracle."""

    def put(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc_millis(column: str):
    """Milliseconds of a time without zone, taken as UTC whatever the session's zone."""
    return F.unix_millis(F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone()))


#: Registry of the stand-in variables: event type, variable, range; one bound alone isn't applied.
REGISTRY_ROWS = "('click', 0, 'Potassium', 1.0D, 300.0D), ('view', 100, 'HR', 0.5D, 250.0D), ('signup', 101, 'SpO2', CAST(NULL AS DOUBLE), 200.0D), ('error', 200, 'Vasopressor', 0.0D, 300.0D)"


def registry(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {REGISTRY_ROWS} AS t(event_type, var_id, name, physio_min, physio_max)")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("entity_id"), utc_millis("ts").alias("time_ms"), "event_type", "value")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.plans.assembly import clean_events

    return clean_events(raw_events(spark, sf_dir), registry(spark), ["event_type"])


def axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a view in the middle third of all days: an axis of day-long segments with gaps."""
    views = raw_events(spark, sf_dir).where("event_type = 'view'").select("entity_id", F.floor(F.col("time_ms") / DAY).alias("day"))
    low, high = F.min("day"), F.max("day")
    third = F.floor((high - low) / 3)
    span = views.agg((low + third).alias("low"), (high - third).alias("high"))
    inside = F.col("day").between(span.select("low").scalar(), span.select("high").scalar())
    days = views.where(inside).distinct().select("entity_id", (F.col("day") * DAY).alias("time_ms"))
    return number_segments(days, ["entity_id"], width=256 * DAY)


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds a day after the first and a day before the last event."""
    return raw_events(spark, sf_dir).groupBy("entity_id").agg((F.min("time_ms") + DAY).alias("ep_start"), (F.max("time_ms") - DAY).alias("ep_end"))


def trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.operators.trajectory import split_events

    return split_events(clean(spark, sf_dir), axis(spark, sf_dir), episodes(spark, sf_dir), pad_ms=DAY)


CTE = f"""
reg(event_type, var_id, name, physio_min, physio_max) AS (VALUES ('click', 0, 'Potassium', 1.0, 300.0), ('view', 100, 'HR', 0.5, 250.0), ('signup', 101, 'SpO2', NULL, 200.0), ('error', 200, 'Vasopressor', 0.0, 300.0)),
raw AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, epoch_us(ts) // 1000 AS time_ms, event_type, value FROM events),
cleaned AS (
  SELECT entity_id, time_ms, var_id, value FROM (
    SELECT r.entity_id, r.time_ms, g.var_id, r.value, row_number() OVER (PARTITION BY r.entity_id, r.time_ms, g.var_id ORDER BY r.event_type, r.value) AS rn
    FROM raw r JOIN reg g USING (event_type)
    WHERE r.value IS NOT NULL AND (g.physio_min IS NULL OR g.physio_max IS NULL OR r.value BETWEEN g.physio_min AND g.physio_max)) WHERE rn = 1),
span AS (SELECT min(d) + (max(d) - min(d)) // 3 AS lo, max(d) - (max(d) - min(d)) // 3 AS hi FROM (SELECT time_ms // {DAY} AS d FROM raw WHERE event_type = 'view')),
axis AS (
  SELECT entity_id, time_ms, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY time_ms) - 1 AS INTEGER) AS seg_idx
  FROM (SELECT DISTINCT entity_id, time_ms // {DAY} * {DAY} AS time_ms FROM raw, span WHERE event_type = 'view' AND time_ms // {DAY} BETWEEN lo AND hi)),
ep AS (SELECT entity_id, min(time_ms) + {DAY} AS ep_start, max(time_ms) - {DAY} AS ep_end FROM raw GROUP BY 1),
bounds AS (SELECT entity_id, min(time_ms) AS ws, max(time_ms) AS wl, count(*) AS n_seg FROM axis GROUP BY 1),
parted AS (
  SELECT c.*, CASE WHEN time_ms BETWEEN ws AND wl + {DAY} THEN 'events'
    WHEN time_ms >= ws - {DAY} AND time_ms < ws THEN 'recent'
    WHEN time_ms >= greatest(ws - {30 * DAY}, ep_start) AND time_ms < ws - {DAY} THEN 'baseline'
    WHEN time_ms > wl + {DAY} AND time_ms <= least(wl + {8 * DAY}, ep_end) THEN 'future' END AS part
  FROM cleaned c JOIN bounds USING (entity_id) JOIN ep USING (entity_id)),
traj AS (
  SELECT p.entity_id, p.time_ms, p.var_id, p.value, p.part,
    CAST(CASE p.part WHEN 'baseline' THEN -2147483648 WHEN 'recent' THEN -2147483647 WHEN 'future' THEN -2147483646 ELSE a.seg_idx END AS INTEGER) AS seg_idx
  FROM (SELECT * FROM parted WHERE part IS NOT NULL) p ASOF LEFT JOIN axis a ON p.entity_id = a.entity_id AND p.time_ms >= a.time_ms)
"""


def sql(body: str) -> str:
    return f"WITH {CTE.strip()}\n{body}"
