"""Monitor files: XML with base64 samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

#: Blocks of a monitor export; stated, as inference takes a lone element for a struct.
CPC = "_datetime string, measurements struct<m: array<struct<_VALUE: string, _name: string>>, mg: array<struct<_name: string, m: array<struct<_VALUE: string, _name: string>>>>>"
FIELDS = ("Wave", "Gain", "Offset", "Points", "Min", "Max")


def read_monitor_xml(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of monitor XML files."""
    return spark.read.format("xml").option("rowTag", "cpc").schema(CPC).load(path)


def _named(items: Column, name: str) -> Column:
    return F.get(F.filter(items, lambda m: m["_name"] == name), F.lit(0))["_VALUE"]


@F.arrow_udf(ArrayType(FloatType()))
def little_endian_16(data: pa.Array) -> pa.Array:
    """Signed 16-bit little-endian numbers of binary values, a batch at once; a last odd byte is left out, null gives none."""
    data = data.cast(pa.binary()).fill_null(b"")
    ends = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, 4 * data.offset) if len(data) else np.zeros(1, np.int32)
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    sizes = np.diff(ends)
    odd = sizes % 2 == 1
    if odd.any():
        raw = np.delete(raw, ends[1:][odd] - 1 - ends[0])
    values = np.frombuffer(raw.tobytes(), "<i2").astype(np.float32)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes // 2)].astype(np.int32)), pa.array(values))


def monitor_blocks(cpc: DataFrame, polled_only: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, block time, channel, gain, offset, bounds and raw samples; with ``polled_only`` blocks without POLLTIME go."""
    rows = cpc.select(*keep, F.col("_datetime").alias("block_time"), _named(F.col("measurements.m"), "POLLTIME").alias("poll_time"), F.explode("measurements.mg").alias("mg"))
    out = rows.select(*keep, "block_time", "poll_time", F.col("mg._name").alias("channel"), *(_named(F.col("mg.m"), f).alias(f.lower()) for f in FIELDS))
    out = out.where("poll_time IS NOT NULL") if polled_only else out
    numbers = {c: F.col(c).try_cast("double") for c in ("gain", "offset", "points", "min", "max")}
    return out.withColumns(numbers).withColumn("samples", little_endian_16(F.unbase64("wave"))).drop("wave")
