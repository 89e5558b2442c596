"""Mixing sources to target weights by Pfair scheduling (operator 2), in built-in functions only.

Each source has a target weight; its documents form blocks. Block j of a source of
weight w is released at slot floor(j/w) and due at slot ceil((j+1)/w); the earliest
deadline among the released blocks takes each slot. Weights are exact rational numbers.
The driver lays out all blocks from the sources' weights and sizes alone; it holds a few
numbers a source and 4 to 30 bytes a block. Documents get the slots of their blocks by
a join, and a hot source is numbered in many small hash buckets: no global sort.

While every source has blocks left, the blocks that a source has had by any slot
differ from slot times weight by less than one. After that (``within_target`` false)
the remaining blocks follow in the order of the middles of their windows and no document is lost.

Defined cases: a null source is a source of its own; an empty table gives no rows;
repeated rows each get a place; any number of sources has its own weights and
deadlines; a source of weight 0 comes last; ties of the hash are ordered by all
columns; input columns named slot, position or within_target give way to the result's.
"""

from __future__ import annotations

import heapq
import math
from array import array
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one source in one numbering bucket, about; buckets at least.
BUCKET_ROWS, LEAST_BUCKETS = 65_536, 256
#: Blocks of a source whose slots travel in one row; a schedule of more blocks than the second isn't broadcast.
CHUNK, BROADCAST_BLOCKS = 1_024, 4_000_000


def parts_of(weights: list[float], period: int) -> list[int]:
    """Whole parts of ``period`` by largest remainder, one at least for each weight."""
    if len(weights) > period:
        raise ValueError("the period must have a slot for each source")
    total, spare = sum(weights), period - len(weights)
    exact = [w / total * period - 1 for w in weights]
    over = sum(max(0.0, x) for x in exact) or 1.0
    exact = [max(0.0, x) * spare / over for x in exact]
    out = [int(x) for x in exact]
    for i in sorted(range(len(out)), key=lambda i: (out[i] - exact[i], i))[: spare - sum(out)]:
        out[i] += 1
    return [x + 1 for x in out]


def whole_weights(weights: list) -> list[int]:
    """The weights as whole numbers in the same proportions, exactly."""
    if any(not math.isfinite(w) or w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must be finite and not negative, and some above 0")
    exact = [Fraction(w) for w in weights]
    common = math.lcm(*{x.denominator for x in exact})
    return [x.numerator * (common // x.denominator) for x in exact]


def earliest_deadline_first(weights: list[int], blocks: list[int]) -> array:
    """The source of each slot up to the first slot that a source without blocks left would get."""
    total = sum(weights)
    waiting = [(0, s) for s, w in enumerate(weights) if w]
    ready: list[tuple[int, int]] = []
    done = [0] * len(weights)
    out = array("i")
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[s] + 1) * total // weights[s]), s))
        s = heapq.heappop(ready)[1]
        if done[s] == blocks[s]:
            return out
        out.append(s)
        done[s] += 1
        heapq.heappush(waiting, (done[s] * total // weights[s], s))
        slot += 1


def lay_out(parts: list[int]) -> list[list[int]]:
    """Slots of one period for each source, whose weights are whole parts of it."""
    order = np.array(earliest_deadline_first(parts, parts))
    return [np.flatnonzero(order == s).tolist() for s in range(len(parts))]


def slots_of(weights: list[int], sizes: list[int], block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The slots of all blocks, source by source; how many each source has; the slot that ends the part within target."""
    counts = np.array([-(-n // block) for n in sizes], dtype=np.int64)
    order = np.array(earliest_deadline_first(weights, [n // block for n in sizes]), dtype=np.int32)
    had = np.bincount(order, minlength=len(sizes))
    left = counts - had
    source = np.repeat(np.arange(len(sizes)), left)
    number = np.arange(len(source)) - np.repeat(np.cumsum(left) - left, left) + had[source]
    total = sum(weights)
    share = np.array([w / total for w in weights])
    with np.errstate(divide="ignore"):
        middle = (number + 0.5) / share[source]
    # Sorted stably: blocks of one source keep their order.
    order = np.concatenate([order, source[np.argsort(middle, kind="stable")].astype(np.int32)])
    return np.argsort(order, kind="stable"), counts, int(had.sum())


def slot_table(spark: SparkSession, keys: pa.Array, slots: np.ndarray, counts: np.ndarray) -> DataFrame:
    """_of (the source's key), _chunk and _slots, those of its blocks from _chunk * CHUNK on."""
    chunks = -(-counts // CHUNK)
    source = np.repeat(np.arange(len(keys)), chunks)
    chunk = np.arange(len(source)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    starts = (np.cumsum(counts) - counts)[source] + chunk * CHUNK
    lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(slots)].astype(np.int32)), pa.array(slots.astype(np.int64)))
    return spark.createDataFrame(pa.table({"_of": keys.take(pa.array(source)), "_chunk": pa.array(chunk.astype(np.int64)), "_slots": lists}))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    temperature: float = 0.7,
    block: int = 16,
    period: int | None = None,
    max_sources: int = 255,
    seed: int = 0,
) -> DataFrame:
    """All columns plus slot, position and within_target; sort by position for the mixed order.

    Without ``weights`` a source's weight is its share of rows to the power ``temperature``.
    Sources that ``weights`` doesn't name share the least of its weights. With a
    ``period`` weights are rounded to whole parts of it, one at least. Above
    ``max_sources`` sources only a schedule of few rows is broadcast; results are the same.
    """
    docs = docs.drop("slot", "position", "within_target")
    # Never null, so that plain joins find a null source too.
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    counts = docs.groupBy("source").count().select("source", "count", key.alias("key")).orderBy(F.desc("count"), F.asc_nulls_first("source")).collect()
    total = sum(r["count"] for r in counts)
    if not total:
        zero = F.lit(0).cast("long")
        return docs.select("*", zero.alias("slot"), zero.alias("position"), F.lit(False).alias("within_target"))
    sizes = [r["count"] for r in counts]
    if weights is None:
        goal = [(n / total) ** temperature for n in sizes]
    else:
        least = min(weights.values())
        goal = [weights.get(r["source"], least) for r in counts]
    slots, blocks, horizon = slots_of(parts_of(goal, period) if period else whole_weights(goal), sizes, block)
    table = slot_table(docs.sparkSession, pa.array([r["key"] for r in counts], pa.string()), slots, blocks)
    if len(slots) <= (BROADCAST_BLOCKS if len(counts) <= max_sources else BROADCAST_BLOCKS // 10):
        table = F.broadcast(table)

    buckets = max(LEAST_BUCKETS, total // BUCKET_ROWS + 1)
    row = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    dealt = docs.withColumns({"_of": key, "_order": order, "_row": row}).withColumn("_bucket", F.shiftright(F.col("_order"), 24) % buckets)
    dealt = dealt.withColumn("_bucket", F.pmod("_bucket", F.lit(buckets)))
    before = dealt.groupBy("_of", "_bucket").count()
    before = before.withColumn("_before", F.sum("count").over(Window.partitionBy("_of").orderBy("_bucket")) - F.col("count")).drop("count")
    within = Window.partitionBy("_of", "_bucket").orderBy("_order", "doc_id", "_row")
    numbered = dealt.withColumn("_number", F.row_number().over(within) - 1).join(before, ["_of", "_bucket"])
    number = F.col("_before") + F.col("_number")
    at = F.floor(number / block)
    placed = numbered.withColumns({"_place": number % block, "_block": at, "_chunk": F.floor(at / CHUNK)}).join(table, ["_of", "_chunk"])
    slot = F.element_at("_slots", (F.col("_block") % CHUNK + 1).cast("int"))
    return placed.withColumn("slot", slot).select(*docs.columns, "slot", (F.col("slot") * block + F.col("_place")).alias("position"), (F.col("slot") < horizon).alias("within_target"))


def in_mixed_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of mixed documents, range-partitioned and sorted so that files read in order give the mixture."""
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select(*columns)
