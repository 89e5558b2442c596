"""Writers of the canonical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; local sessions without it get one of their own."""
    before = spark.sparkContext._jsc.sc().getCheckpointDir()
    shared = spark.conf.get("spark.checkpoint.dir", None) or (before.get() if before.isDefined() else None)
    if not shared:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="bedside-")
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def write_events(events: DataFrame, path: str) -> None:
    events.write.mode("overwrite").parquet(path)  # K1


def write_trajectory(trajectory: DataFrame, path: str, keys: tuple[str, ...] = ("dataset", "part"), partitions: int | None = None, dry_run: bool = False) -> DataFrame:
    """Partitioned by part, in order of time within an entity (K2, K10: a dry run writes nothing)."""
    spread = [F.pmod(F.xxhash64("entity_id", "part"), F.lit(1024))]
    laid = trajectory.repartition(partitions, *keys, *spread) if partitions else trajectory.repartition(*keys, *spread)
    laid = laid.sortWithinPartitions(*keys, "entity_id", "time_ms", "var_id")
    if not dry_run:
        laid.write.mode("overwrite").partitionBy(*keys).parquet(path)
    return laid


def write_segments(segments: DataFrame, path: str) -> None:
    segments.sortWithinPartitions("channel", "entity_id", "seg_idx").write.mode("overwrite").partitionBy("channel").parquet(path)  # K3


def entity_meta(trajectory: DataFrame, by: list[str], layout_version: int) -> DataFrame:
    """Counts per entity and part as one row of metadata (K4)."""
    counts = trajectory.groupBy(*by, "part").agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("part", "n")))).alias("n_by_part"), F.sum("n").alias("n_events")).withColumn("layout_version", F.lit(layout_version))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)  # K5, K7, K9


def write_split_lists(rows: DataFrame, path: str) -> None:
    """One folder of JSON lines per split (K6), so that no split is gathered in one row."""
    rows.write.mode("overwrite").partitionBy("split").json(path)


def write_demographics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)  # K8


def run_summary(df: DataFrame, reason: str) -> DataFrame:
    """Rows, successes and reasons of a run (K9)."""
    return df.groupBy(F.coalesce(reason, F.lit("ok")).alias("status")).agg(F.count("*").alias("n"))
