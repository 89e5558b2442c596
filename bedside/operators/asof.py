"""As-of joins by one ordered pass over the union of both sides.

An entity may hold a third of all rows, so rows are windowed by entity and time
bucket; what a bucket needs from the buckets before is carried by a table of one row
per bucket. Null keys match nothing, as in other joins: right rows with one are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedside.schemas import DAY_MS


def keyed(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows without a null key."""
    return rows.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in by))) if by else rows


def as_of(left: DataFrame, right: DataFrame, by: list[str], on: str, take: list[str], forward: bool = False, strict: bool = False, bucket_ms: int = DAY_MS) -> DataFrame:
    """``left`` with ``take`` of the last row of ``right`` at or before its time.

    ``strict`` takes only earlier rows (J9); ``forward`` the next row instead. Right
    rows of equal time: the greatest ``take`` wins backward, the least forward.
    """
    sign = -1 if forward else 1
    row_type = left.select(F.struct("*")).schema[0].dataType
    r = keyed(right, by).select(*by, (F.col(on) * sign).alias("_t"), F.struct(*(F.col(c) for c in take)).alias("_take"))
    if forward:  # of rows at one time the least values
        r = r.groupBy(*by, "_t").agg(F.min("_take").alias("_take"))
    # At equal times a right row comes before left rows, or after them if strict.
    r = r.withColumns({"_kind": F.lit(1 if strict else 0), "_row": F.lit(None).cast(row_type)})
    rows = left.select(*by, (F.col(on) * sign).alias("_t"), F.lit(None).cast(r.schema["_take"].dataType).alias("_take"), F.lit(0 if strict else 1).alias("_kind"), F.struct("*").alias("_row"))
    both = r.unionByName(rows).withColumn("_bucket", F.floor(F.col("_t") / bucket_ms))
    order = Window.partitionBy(*by, "_bucket").orderBy("_t", "_kind", "_take").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("_near", F.last("_take", ignorenulls=True).over(order))
    # What a bucket takes over from the ones before it: one row per bucket with rows of the left side. Taken from
    # the windowed rows themselves, so Spark reads both sides once and reuses their exchange.
    end = F.max(F.struct("_t", "_kind", "_near"))["_near"]
    ends = near.groupBy(*by, "_bucket").agg(end.alias("_end"), F.count("_row").alias("_asked"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(before)).where("_asked > 0").select(*by, "_bucket", "_carry")
    near = near.where("_row IS NOT NULL")
    out = near.join(carry, [*by, "_bucket"], "left")
    chosen = F.coalesce("_near", "_carry")
    return out.select("_row.*", *(chosen[c].alias(c) for c in take))


def nearest(left: DataFrame, right: DataFrame, by: list[str], on: str, value: str, tolerance: int) -> DataFrame:
    """``left`` with ``value`` of the nearest right row less than ``tolerance`` away, the earlier of two."""
    row_type, bucket = left.select(F.struct("*")).schema[0].dataType, F.floor(F.col("_t") / tolerance)
    r = keyed(right, by).select(*by, F.col(on).alias("_t"), F.struct(F.col(on).alias("at"), F.col(value).alias("value")).alias("_take"))
    # Nothing nearer than the tolerance is more than one bucket away: each side is read once, and no bucket needs another.
    r = r.withColumns({"_kind": F.lit(0), "_row": F.lit(None).cast(row_type), "_bucket": F.explode(F.array(bucket - 1, bucket, bucket + 1))})
    rows = left.select(*by, F.col(on).alias("_t"), F.lit(None).cast(r.schema["_take"].dataType).alias("_take"), F.lit(1).alias("_kind"), F.struct("*").alias("_row"), bucket.alias("_bucket"))
    order = Window.partitionBy(*by, "_bucket").orderBy("_t", "_kind", "_take")
    before = F.last("_take", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("_take", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    near = r.unionByName(rows).select("_row", before.alias("_a"), after.alias("_b")).where("_row IS NOT NULL")
    a, b, t = F.col("_a"), F.col("_b"), F.col("_row")[on]
    d1, d2 = t - a["at"], b["at"] - t
    earlier = (d1 < tolerance) & (d2.isNull() | (d1 <= d2))
    pick = F.when(earlier, a["value"]).when(d2 < tolerance, b["value"])
    delta = F.when(earlier, -d1).when(d2 < tolerance, d2)
    return near.select(*(F.col("_row")[c].alias(c) for c in left.columns if c not in (value, "delta_ms")), pick.alias(value), delta.alias("delta_ms"))
