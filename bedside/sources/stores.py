"""Stored tables that are changed in place or joined without moving signals.

A trajectory store has a folder per bucket of entities; a change rewrites only the buckets
whose rows it changes (M6, U5). A signal store is bucketed by entity and block of segments, so
that samples are cut where the signals lie (K3, M18).
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bedside.operators.quality import counts_of, failures

#: A store has at most this many buckets; a change lists those it touches.
MOST_BUCKETS = 65_536
KEYS = ("entity_id", "time_ms", "var_id", "value")


def _laid(rows: DataFrame, buckets: int, spread: int, by: str) -> DataFrame:
    """Rows with their bucket, a bucket over ``spread`` tasks by time, so that an entity of any size is many tasks."""
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"a store has 1 to {MOST_BUCKETS} buckets")
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int"))
    laid = placed.repartition("bucket", F.pmod(F.xxhash64("time_ms"), F.lit(spread)))
    return laid.sortWithinPartitions("bucket", by, "time_ms", "var_id")


def write_store(trajectory: DataFrame, path: str, buckets: int, spread: int = 4, by: str = "entity_id") -> None:
    """A new store of ``trajectory``; null entities share a bucket, columns named ``bucket`` are replaced."""
    _laid(trajectory, buckets, spread, by).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_store(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The events of a store; a store without any rows needs its ``schema``, with ``bucket``."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _rewrite(store: DataFrame, rows: DataFrame, path: str, buckets: int, spread: int, by: str) -> None:
    laid = _laid(rows.select(*(c for c in store.columns if c != "bucket")), buckets, spread, by)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def _buckets_of(rows: DataFrame, buckets: int, by: str = "entity_id") -> list[int]:
    """Buckets that rows fall in: at most ``buckets`` numbers."""
    return [r[0] for r in rows.select(F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int")).distinct().collect()]


def merge_into(spark: SparkSession, path: str, incoming: DataFrame, buckets: int, spread: int = 4, by: str = "entity_id", keys: tuple[str, ...] = KEYS) -> list[int]:
    """Add the events that the store hasn't got (M6); returns the buckets written.

    Events are the same where all ``keys`` are, nulls included; of repeated incoming events one is added. Only the buckets
    of incoming rows are read and only those with a new event are written, whole, after all is
    computed, so a job that fails leaves the store as it was and may run again. Merging again writes nothing.
    """
    store = read_store(spark, path)
    near = store.where(F.col("bucket").isin(_buckets_of(incoming, buckets, by)))
    same = functools.reduce(operator.and_, (incoming[k].eqNullSafe(near[k]) for k in keys))
    fresh = incoming.join(near, same, "left_anti").dropDuplicates(list(keys))
    touched = _buckets_of(fresh, buckets, by)
    if touched:
        rest = [c for c in store.columns if c != "bucket"]
        kept = store.where(F.col("bucket").isin(touched)).select(*rest)
        _rewrite(store, kept.unionByName(fresh.select(*rest)), path, buckets, spread, by)
    return sorted(touched)


def replace_in(spark: SparkSession, path: str, incoming: DataFrame, low: int, high: int, buckets: int, spread: int = 4, by: str = "entity_id") -> list[int]:
    """Replace all events of variables ``low`` to ``high`` by those of ``incoming`` (U5); returns the buckets written.

    A bucket is written only if its events of the band differ, counted as often as they occur; an entity that isn't in ``incoming``
    loses its events of the band. Replacing again writes nothing.
    """
    store = read_store(spark, path)
    rest = [c for c in store.columns if c != "bucket"]
    band = F.col("var_id").between(low, high)
    old, new = store.where(band).select(*rest), incoming.where(band).select(*rest)
    balance = old.withColumn("_n", F.lit(1)).unionByName(new.withColumn("_n", F.lit(-1))).groupBy(*rest).agg(F.sum("_n").alias("_n"))
    touched = _buckets_of(balance.where("_n <> 0"), buckets, by)
    if touched:
        bucket = F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int")
        kept = store.where(F.col("bucket").isin(touched) & ~F.coalesce(band, F.lit(False))).select(*rest)
        result = kept.unionByName(new.where(bucket.isin(touched)))
        filled = _buckets_of(result, buckets, by)
        _rewrite(store, result, path, buckets, spread, by)
        _drop_buckets(spark, path, set(touched) - set(filled))
    return sorted(touched)


def _drop_buckets(spark: SparkSession, path: str, emptied: set[int]) -> None:
    """Remove buckets left without rows: a dynamic overwrite leaves alone what it gets no rows for."""
    jvm = spark.sparkContext._jvm
    for bucket in emptied:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={bucket}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_checked(rows: DataFrame, path: str | None, checks: list[tuple[str, str, Column]], partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write rows and count what fails each (name, severity, condition) on the way: one job, no second scan (M4, K9).

    The counts are taken in the writing tasks, whose results Spark counts once however often a task is tried. Without
    a path it is a dry run (K10): the same report, nothing written. The report has a row per check, one named ``rows`` first.
    """
    seen = Observation()
    watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts_of(checks))
    if path is None:
        watched.write.format("noop").mode("overwrite").save()
    else:
        watched.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    found = seen.get
    out = [("rows", "info", found["rows"], True)] + failures(checks, found)
    return rows.sparkSession.createDataFrame(out, "check string, severity string, n_bad long, passed boolean")


def write_signals(segments: DataFrame, name: str, path: str, buckets: int, block: int, halo: int, by: str = "entity_id") -> None:
    """A table of signals, a row per entity, block of ``block`` segments, channel and rate, bucketed by entity and block (K3).

    A block also holds the first ``halo`` segments of the next one, so a window of at most ``halo`` + 1 segments lies whole in the
    block it begins in. A row is bounded by block and halo; an entity is many rows and may have any share of the signals. Segments are
    entity, seg_idx, time_ms, channel, fs and samples; other columns are left out.
    """
    if not 0 <= halo <= block:
        raise ValueError("the halo is at most a block")
    home = F.floor(F.col("seg_idx") / block).cast("int")
    first = F.floor((F.col("seg_idx") - halo) / block).cast("int")
    # A segment lies in its own block and, within the halo, in the one before.
    at = F.when(first < home, F.array(first, home)).otherwise(F.array(home))
    rows = segments.select(by, "channel", "fs", F.struct("seg_idx", "time_ms", "samples").alias("_part"), F.explode(at).alias("block"))
    blocks = rows.repartition(buckets, by, "block").groupBy(by, "block", "channel", "fs").agg(F.sort_array(F.collect_list("_part")).alias("parts"))
    writer = blocks.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, by, "block").sortBy(by, "block").saveAsTable(name)


def cut_samples(index: DataFrame, name: str, buckets: int, block: int, halo: int, by: str = "entity_id") -> DataFrame:
    """Samples of ``index`` with their signals by channel, cut where the signals lie: only the index is shuffled.

    The arguments are those the table was written with. Equal to ``samples.materialise``; repeated rows of the index give one
    sample, samples without any segment go, and of a channel at several rates the highest is taken. A window of over ``halo`` + 1
    segments or beyond its signal is an error.
    """
    keys = index.columns
    reach = F.assert_true(F.col("seg_hi") - F.col("seg_lo") <= halo, F.lit("a window is longer than the table's halo"))
    home = F.when(reach.isNull(), F.floor(F.col("seg_lo") / block).cast("int"))
    wanted = index.distinct().withColumn("block", home).repartition(buckets, by, "block")
    signals = index.sparkSession.table(name).select(by, "block", "channel", F.col("fs").alias("_fs"), F.col("parts").alias("_parts"))
    inside = F.filter("_parts", lambda p: p["seg_idx"].between(F.col("seg_lo"), F.col("seg_hi")))
    found = wanted.join(signals, [by, "block"]).withColumn("_parts", inside).where(F.size("_parts") > 0)
    first = F.round((F.col("t_start") - F.col("_parts")[0]["time_ms"]) * F.col("_fs") / 1000).cast("int")
    n = F.round((F.col("t_end") - F.col("t_start")) * F.col("_fs") / 1000).cast("int")
    whole = F.flatten(F.col("_parts")["samples"])
    fits = F.assert_true((first >= 0) & (first + n <= F.size(whole)), F.lit("a window reaches beyond its signal"))
    cut = found.withColumn("_wave", F.when(fits.isNull(), F.slice(whole, first + 1, n)))
    # The block stays a key, so that the groups are those of the table's buckets.
    best = cut.groupBy(*keys, "block", "channel").agg(F.max_by("_wave", "_fs").alias("_wave"))
    waves = F.map_from_entries(F.sort_array(F.collect_list(F.struct("channel", "_wave"))))
    return best.groupBy(*keys, "block").agg(waves.alias("waveforms")).drop("block")
