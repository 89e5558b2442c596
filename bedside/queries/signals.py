"""Queries on array signals; rows of ``embeddings`` stand in for recorded segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from bedside.functions.clean import valid_samples
from bedside.operators import resample, segments
from bedside.queries.common import query, table

#: Signals with some missing samples: values under -0.25 are missing.
SIG = "sig AS (SELECT label AS entity_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INTEGER) AS seg_idx, vec_id, list_transform(embedding, lambda x: CASE WHEN x < -0.25 THEN CAST('nan' AS FLOAT) ELSE x END) AS samples FROM embeddings)"


def signals(spark, sf):
    nan = F.lit(float("nan")).cast("float")
    e = table(spark, sf, "embeddings").select(F.col("label").alias("entity_id"), "vec_id", F.transform("embedding", lambda x: F.when(x < -0.25, nan).otherwise(x)).alias("samples"))
    return segments.number_segments(e, ["entity_id"], "vec_id", 4096)


@query(f"WITH {SIG} SELECT vec_id, CAST(i // 8 AS INTEGER) AS place, round(list_sum(list_transform(samples[i + 1 : i + 16], lambda x: CASE WHEN isnan(x) THEN 0 ELSE CAST(x AS DOUBLE) END)), 5) AS total FROM sig, unnest(range(0, 49, 8)) AS u(i)")
def cut_overlapping(spark, sf):
    cut = segments.cut(signals(spark, sf), "samples", 16, 8)
    total = F.aggregate("segment", F.lit(0.0), lambda a, x: a + F.when(F.isnan(x), 0.0).otherwise(x.cast("double")))
    return cut.select("vec_id", F.col("place").cast("int").alias("place"), F.round(total, 5).alias("total"))


@query(f"WITH {SIG} SELECT vec_id, CAST(i // 16 AS INTEGER) AS place, len(list_filter(samples[i + 1 : i + 16], lambda x: isnan(x))) / 16 AS nan_share FROM sig, unnest(range(0, 49, 16)) AS u(i) WHERE len(list_filter(samples[i + 1 : i + 16], lambda x: isnan(x))) / 16 <= 0.05")
def nan_gate(spark, sf):
    cut = segments.cut(signals(spark, sf), "samples", 16, 16)
    return cut.where(segments.nan_gate(F.col("segment"), 0.05)).select("vec_id", F.col("place").cast("int").alias("place"), segments.nan_fraction(F.col("segment")).alias("nan_share"))


@query(f"WITH {SIG}, n AS (SELECT *, len(list_filter(samples, lambda x: isnan(x))) AS k FROM sig) SELECT entity_id, round(sum(k) / sum(len(samples)), 8) AS nan_ratio, round(avg(CAST(k < len(samples) AS INTEGER)), 8) AS valid_ratio, count(*) AS n_seg FROM n GROUP BY 1")
def channel_quality(spark, sf):
    return segments.channel_quality(signals(spark, sf), ["entity_id"]).withColumns({c: F.round(c, 8) for c in ("nan_ratio", "valid_ratio")})


@query(f"WITH {SIG} SELECT vec_id, CAST(vec_id * 1000 + (i - 1) * 25 AS BIGINT) AS time_ms, samples[i] AS value FROM sig, unnest(range(1, 65)) AS u(i) WHERE NOT isnan(samples[i])")
def sparse_events(spark, sf):
    s = signals(spark, sf).withColumn("start", F.col("vec_id") * 1000)
    return segments.to_events(s, ["vec_id"], "samples", "start", 25).select("vec_id", "time_ms", "value")


@query(f"WITH {SIG}, g AS (SELECT *, list_filter(samples, lambda x: NOT isnan(x)) AS good FROM sig WHERE seg_idx % 3 = 0) SELECT vec_id, entity_id, seg_idx, round(list_avg(list_transform(good, lambda x: CAST(x AS DOUBLE))), 5) AS mean, round(list_stddev_pop(list_transform(good, lambda x: CAST(x AS DOUBLE))), 5) AS std, (64 - len(good)) / 64 AS nan_ratio FROM g")
def envelope(spark, sf):
    return segments.envelope(signals(spark, sf), 3).withColumns({c: F.round(c, 5) for c in ("mean", "std")})


@query(
    f"""WITH {SIG},
d AS (SELECT entity_id, seg_idx // 2 AS second, vec_id, samples FROM sig),
l AS (SELECT entity_id, second, arg_max(samples, vec_id) AS samples FROM d GROUP BY ALL),
q AS (SELECT * FROM l WHERE len(list_filter(samples, lambda x: isnan(x))) < 32),
w AS (SELECT entity_id, second // 4 AS "window", count(*) AS c FROM q GROUP BY ALL)
SELECT w.entity_id, CAST("window" AS BIGINT) AS "window", CAST(c AS INTEGER) AS coverage_s,
  flatten(list(CASE WHEN samples IS NULL THEN list_transform(range(0, 64), lambda i: -9)
    ELSE list_transform(samples, lambda x: CASE WHEN isnan(x) THEN -9 ELSE CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) END) END ORDER BY i)) AS samples
FROM w, unnest(range(0, 4)) AS u(i) LEFT JOIN q ON q.entity_id = w.entity_id AND q.second = "window" * 4 + i GROUP BY ALL"""
)
def assembled_seconds(spark, sf):
    """Two blocks of each second, of which the later one counts."""
    blocks = signals(spark, sf).withColumn("second", F.floor(F.col("seg_idx") / 2))
    out = segments.assemble_seconds(blocks, ["entity_id"], "second", "samples", 64, 4, order="vec_id")
    whole = F.transform("samples", lambda x: F.when(F.isnan(x), -9).otherwise(F.round(x.cast("double") * 1_000_000)).cast("bigint"))
    return out.withColumn("samples", whole)


@query(f"WITH {SIG}, q AS (SELECT entity_id, seg_idx // 4 AS w, count(*) AS c FROM sig WHERE len(list_filter(samples, lambda x: isnan(x))) < 2 GROUP BY ALL) SELECT entity_id, count(*) FILTER (c = 4) AS n_clean FROM q GROUP BY 1 HAVING count(*) FILTER (c = 4) >= 2")
def clean_entities(spark, sf):
    good = signals(spark, sf).where(segments.nan_fraction(F.col("samples")) < 2 / 64)
    return segments.clean_entities(segments.assemble_seconds(good, ["entity_id"], "seg_idx", "samples", 64, 4), ["entity_id"], 4, 2)


@query(f"""WITH {SIG}, b AS (SELECT *, CASE WHEN len(list_filter(samples, lambda x: isnan(x))) > 1 THEN 1 ELSE 0 END AS broken FROM sig),
r AS (SELECT *, CASE WHEN broken = 0 AND coalesce(lag(broken) OVER (PARTITION BY entity_id ORDER BY seg_idx), 1) = 1 THEN 1 ELSE 0 END AS start FROM b),
i AS (SELECT *, sum(start) OVER (PARTITION BY entity_id ORDER BY seg_idx) - 1 AS block_id FROM r)
SELECT entity_id, CAST(block_id AS BIGINT) AS block_id, min(seg_idx) AS first, count(*) AS n FROM i WHERE broken = 0 GROUP BY ALL""")
def anchor_blocks(spark, sf):
    s = signals(spark, sf)
    broken = F.size(F.filter("samples", lambda x: F.isnan(x))) > 1
    return segments.anchor_blocks(s, ["entity_id"], "seg_idx", broken).groupBy("entity_id", "block_id").agg(F.min("seg_idx").alias("first"), F.count("*").alias("n"))


@query("""WITH f AS (SELECT label AS entity_id, vec_id, CAST(vec_id % 50 * 40 + (i - 1) * 10 AS BIGINT) AS t, embedding[i] AS x FROM embeddings, unnest(range(1, 65)) AS u(i)),
g AS (SELECT entity_id, t // 10 AS g, arg_max(x, vec_id) AS x FROM f WHERE t >= 0 AND t < 1500 GROUP BY ALL)
SELECT entity_id, CAST(g // 30 AS INTEGER) AS seg_idx, count(*) AS n, round(sum(CAST(x AS DOUBLE)), 4) AS total FROM g GROUP BY ALL""")
def grid_placement(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("label").alias("entity_id"), "vec_id", (F.col("vec_id") % 50 * 40).alias("start"), F.lit(0).alias("ep_start"), F.lit(1500).alias("ep_end"), F.col("embedding").alias("samples"))
    out = segments.place_on_grid(e, ["entity_id"], "start", "samples", "vec_id", "ep_start", "ep_end", 10, 30)
    good = F.filter("samples", lambda x: ~F.isnan(x))
    return out.select("entity_id", "seg_idx", F.size(good).cast("bigint").alias("n"), F.round(F.aggregate(good, F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


@query(
    """WITH f AS (
  SELECT label AS entity_id, vec_id, CAST(vec_id * 37 % 1600 + (i - 1) * 10 - 100 AS BIGINT) AS t, CAST(round(CAST(embedding[i] AS DOUBLE) * 1000000) AS BIGINT) AS x
  FROM embeddings, unnest(range(1, 65)) AS u(i)
), g AS (SELECT entity_id, CAST(floor(t / 10) AS BIGINT) AS g, arg_max(x, vec_id) AS x FROM f WHERE t >= 0 AND t < 1505 GROUP BY ALL),
s AS (SELECT DISTINCT entity_id, g // 50 AS s FROM g)
SELECT s.entity_id, CAST(s AS INTEGER) AS seg_idx, list(coalesce(x, -9) ORDER BY i) AS samples
FROM s, unnest(range(0, 50)) AS u(i) LEFT JOIN g ON g.entity_id = s.entity_id AND g.g = s * 50 + i GROUP BY ALL"""
)
def overlaid_chunks(spark, sf):
    """Chunks at any phase of the grid, laid over one another in segments of 50 samples."""
    e = table(spark, sf, "embeddings").select(F.col("label").alias("entity_id"), "vec_id", F.col("embedding").alias("samples"))
    e = e.withColumns({"start": F.col("vec_id") * 37 % 1600 - 100, "ep_start": F.lit(0), "ep_end": F.lit(1505)})
    out = segments.place_on_grid(e, ["entity_id"], "start", "samples", "vec_id", "ep_start", "ep_end", 10, 50)
    whole = F.transform("samples", lambda x: F.when(F.isnan(x), -9).otherwise(F.round(x.cast("double") * 1_000_000)).cast("bigint"))
    return out.select("entity_id", "seg_idx", whole.alias("samples"))


@query("SELECT vec_id, list_transform(embedding, lambda x: round(CASE WHEN CAST(x AS DOUBLE) <= CAST(-0.15 AS DOUBLE) OR CAST(x AS DOUBLE) >= CAST(0.25 AS DOUBLE) OR CAST(CAST(CAST(x AS DOUBLE) * 2 + 1 AS FLOAT) AS DOUBLE) < CAST(0.6 AS DOUBLE) OR CAST(CAST(CAST(x AS DOUBLE) * 2 + 1 AS FLOAT) AS DOUBLE) > CAST(1.3 AS DOUBLE) THEN CAST(-9 AS DOUBLE) ELSE CAST(CAST(CAST(x AS DOUBLE) * 2 + 1 AS FLOAT) AS DOUBLE) END, 4)) AS samples FROM embeddings")
def scaled_samples(spark, sf):
    out = valid_samples(F.col("embedding"), F.lit(0.6), F.lit(1.3), F.lit(2.0), F.lit(1.0), (-0.15, 0.25))
    return table(spark, sf, "embeddings").select("vec_id", F.transform(out, lambda x: F.when(F.isnan(x), -9.0).otherwise(F.round(x.cast("double"), 4))).alias("samples"))


@query()
def resampled(spark, sf):
    """Polyphase resampling has no SQL form; a test compares it with direct convolution."""
    s = signals(spark, sf).withColumn("fs", F.lit(64))
    return resample.resample_blocks(s, 40).select("vec_id", "fs", "samples")


@query("SELECT vec_id, round(coalesce(embedding[1], 0), 6) AS first, CAST(64 AS INTEGER) AS n FROM embeddings")
def missing_channels(spark, sf):
    e = table(spark, sf, "embeddings")
    filled = segments.or_missing(F.col("embedding"), 64)
    return e.select("vec_id", F.round(filled[0], 6).alias("first"), F.size(filled).alias("n"))
