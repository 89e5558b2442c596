"""Inventories of files and of plain-text signal headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Names of header files that hold no signal of their own.
SKIP = r"(_layout|n)\.hea$"


def file_inventory(spark: SparkSession, folder: str, glob: str, pattern: str) -> DataFrame:
    """Files per entity (S10); only names and lengths are read. ``pattern`` has groups for entity and number."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select("path", "length")
    return inventory(files, pattern)


def inventory(files: DataFrame, pattern: str) -> DataFrame:
    entity, number = F.regexp_extract("path", pattern, 1), F.regexp_extract("path", pattern, 2).try_cast("int")
    rows = files.select(entity.alias("entity_id"), number.alias("number"), "path", "length").where("entity_id <> ''")
    return rows.groupBy("entity_id").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"), F.min("number").alias("first"), F.max("number").alias("last"))


def read_headers(spark: SparkSession, folder: str, glob: str = "*.hea") -> DataFrame:
    """path and text of each header file below a folder; a header is one row."""
    return spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def channels(headers: DataFrame) -> DataFrame:
    """path, record, fs, n_samples and channel of signal headers (S11); layouts, masters and numerics are skipped."""
    lines = headers.where(~F.col("path").rlike(SKIP)).select("path", F.filter(F.split("text", "\r?\n"), lambda x: (F.trim(x) != "") & ~F.startswith(x, F.lit("#"))).alias("lines"))
    first = F.split(F.trim(F.get("lines", F.lit(0))), r"\s+")
    return lines.where(~F.get(first, F.lit(0)).contains("/")).select("path", F.get(first, F.lit(0)).alias("record"), F.regexp_extract(F.coalesce(F.get(first, F.lit(2)), F.lit("250")), r"^[0-9.]+", 0).try_cast("double").alias("fs"), F.get(first, F.lit(3)).try_cast("bigint").alias("n_samples"), F.explode(F.slice("lines", 2, F.size("lines"))).alias("line")).select("path", "record", "fs", "n_samples", F.element_at(F.split(F.trim("line"), r"\s+"), -1).alias("channel"))


def subject_channels(rows: DataFrame, subject_pattern: str, wanted: list[str]) -> DataFrame:
    """Samples, seconds and wanted channels per subject."""
    s = rows.withColumn("subject", F.regexp_extract("path", subject_pattern, 1))
    return s.groupBy("subject").agg(*(F.coalesce(F.sum(F.when(F.col("channel") == c, F.col("n_samples") / F.col("fs"))), F.lit(0.0)).alias(f"seconds_{c}") for c in wanted), F.sort_array(F.collect_set("channel")).alias("channels"))


def master_segments(headers: DataFrame) -> DataFrame:
    """Segments of multi-segment headers with their first sample (S12); a gap is named ~."""
    lines = headers.select("path", F.split("text", "\r?\n").alias("lines"))
    first = F.split(F.trim(F.get("lines", F.lit(0))), r"\s+")
    rows = lines.where(F.get(first, F.lit(0)).contains("/")).select("path", F.regexp_extract(F.get(first, F.lit(2)), r"^[0-9.]+", 0).try_cast("double").alias("fs"), F.concat_ws(" ", F.get(first, F.lit(4)), F.get(first, F.lit(5))).alias("start"), F.posexplode(F.slice("lines", 2, F.size("lines"))).alias("place", "line"))
    parts = F.split(F.trim("line"), r"\s+")
    rows = rows.select("path", "fs", "start", "place", F.get(parts, F.lit(0)).alias("segment"), F.get(parts, F.lit(1)).try_cast("bigint").alias("n_samples")).where("n_samples IS NOT NULL")
    before = F.sum("n_samples").over(Window.partitionBy("path").orderBy("place")) - F.col("n_samples")
    return rows.withColumns({"first_sample": before, "is_gap": F.col("segment") == "~"})
