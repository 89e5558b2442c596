"""Which times are kept if each must be an interval after the last one kept, as functions composed over buckets of time.

From a kept time the next one is settled: the first at least an interval later. So a bucket of times is a
function from the last time kept before it to the last time kept after it, and that is a sorted table: the first
time that is kept, and the last time of the chain it begins. Only times in the bucket's first interval can
come first (and one more), so the table is small where a bucket spans many intervals.

1. Tasks make the table of each key and bucket (jumps by binary search, chains by doubling).
2. Tables of ``SPAN`` buckets each are composed; then one row per composed table is walked in order of time.
3. Those states are walked into the buckets, and each bucket marks its chain by doubling.

A key with a third of all times is many buckets and as many tasks; what is walked in one task is a row per
``SPAN`` * ``SPAN`` intervals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Intervals in a bucket, and buckets in a group of them.
SPAN = 64
NEVER = np.iinfo(np.int64).min


def jumps(times: np.ndarray, interval: int) -> np.ndarray:
    """For each of these sorted times the place of the next one kept; their number where there is none."""
    return np.searchsorted(times, times + interval)


def chain_ends(following: np.ndarray) -> np.ndarray:
    """The place where the chain from each place ends."""
    n = len(following)
    to = np.where(following < n, following, np.arange(n))
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


def chain(following: np.ndarray, first: int) -> np.ndarray:
    """Whether each place is on the chain from ``first``."""
    n = len(following)
    on = np.zeros(n + 1, dtype=bool)
    on[first] = True
    to = np.r_[following, n]
    while (to < n).any():
        on[to[on]] = True
        to = to[to]
    return on[:n]


def trimmed(starts: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A table cut after the first start at or after ``limit``; of starts with one end the last stays."""
    n = min(int(np.searchsorted(starts, limit)) + 1, len(starts))
    starts, ends = starts[:n], ends[:n]
    stays = np.r_[ends[1:] != ends[:-1], True] if n else np.zeros(0, bool)
    return starts[stays], ends[stays]


def applied(last: np.ndarray, starts: np.ndarray, ends: np.ndarray, interval: int) -> np.ndarray:
    """The last kept times after a table, from those before it (``NEVER``: none was kept)."""
    at = np.searchsorted(starts, np.where(last == NEVER, NEVER, last + interval))
    return np.where(at < len(starts), ends[np.minimum(at, len(ends) - 1)], last)


def composed(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray], interval: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The table of one after another."""
    late = second[0] > first[0][-1]
    starts = np.concatenate([first[0], second[0][late]])
    ends = np.concatenate([applied(first[1], *second, interval), second[1][late]])
    return trimmed(starts, ends, limit)


def _runs(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Slices of batches whose first ``width`` columns are equal, with those values; equal rows come together."""
    held: list[pa.RecordBatch] = []
    key: tuple = ()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        fresh = np.zeros(n, dtype=bool)
        fresh[0] = True
        for i in range(width):
            codes = batch.column(i).dictionary_encode(null_encoding="encode").indices.to_numpy()
            fresh[1:] |= codes[1:] != codes[:-1]
        edges = [*np.flatnonzero(fresh).tolist(), n]
        for a, b in zip(edges, edges[1:]):
            here = tuple(batch.column(i)[a].as_py() for i in range(width))
            if held and here != key:
                yield key, held
                held = []
            key = here
            held.append(batch.slice(a, b - a))
    if held:
        yield key, held


def _grouped(df: DataFrame, keys: list[str], order: str, make: Callable, columns: list[str], schema: str) -> DataFrame:
    """``make(key, rows)`` over the rows of each key in order, its records gathered in batches."""
    kinds = dict(df.dtypes)
    names = [*keys, *(c.split(" ")[0] for c in schema.split(", "))]
    full = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), schema])
    width = len(keys)
    arrow = {"bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}
    types = [arrow[c.split(" ")[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        fields: list[pa.DataType] = []

        def batch() -> pa.RecordBatch:
            data = [pa.array(c, k) for c, k in zip(zip(*out), [*fields, *types])]
            return pa.RecordBatch.from_arrays(data, names=names)

        for key, held in _runs(batches, width):
            fields = [held[0].schema.field(i).type for i in range(width)]
            made = pa.Table.from_batches(held).select(range(width, held[0].num_columns))
            out += [(*key, *row) for row in make(key, made)]
            if len(out) >= 10_000:
                yield batch()
                out = []
        if out:
            yield batch()

    dealt = df.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys, order)
    return dealt.mapInArrow(run, full)


def bucket_tables(times: DataFrame, by: list[str], interval: int) -> DataFrame:
    """Key, _group, _bucket and the bucket's table as _starts and _ends."""

    def make(key: tuple, rows: pa.Table) -> Iterator[tuple]:
        t = rows["_t"].to_numpy()
        ends = t[chain_ends(jumps(t, interval))]
        starts, ends = trimmed(t, ends, key[-1] * interval * SPAN + interval)
        yield starts.tolist(), ends.tolist()

    return _grouped(times, [*by, "_group", "_bucket"], "_t", make, ["_t"], "_starts array<bigint>, _ends array<bigint>")


def group_tables(tables: DataFrame, by: list[str], interval: int) -> DataFrame:
    """The composed table of each key and group of buckets."""

    def make(key: tuple, rows: pa.Table) -> Iterator[tuple]:
        limit = key[-1] * interval * SPAN * SPAN + interval
        whole = None
        for starts, ends in zip(rows["_starts"], rows["_ends"]):
            table = starts.values.to_numpy(), ends.values.to_numpy()
            whole = trimmed(*table, limit) if whole is None else composed(whole, table, interval, limit)
        yield whole[0].tolist(), whole[1].tolist()

    return _grouped(tables, [*by, "_group"], "_bucket", make, ["_bucket", "_starts", "_ends"], "_starts array<bigint>, _ends array<bigint>")


def states(tables: DataFrame, by: list[str], order: str, interval: int, begin: str | None = None) -> DataFrame:
    """``by``, ``order`` and ``_last``, the time kept last before each table (``begin`` before the first; default: none)."""

    def make(_: tuple, rows: pa.Table) -> Iterator[tuple]:
        last = np.array([rows[begin][0].as_py() if begin else NEVER], dtype=np.int64)
        for at, starts, ends in zip(rows[order].to_pylist(), rows["_starts"], rows["_ends"]):
            yield at, int(last[0])
            last = applied(last, starts.values.to_numpy(), ends.values.to_numpy(), interval)

    columns = [order, "_starts", "_ends", *([begin] if begin else [])]
    return _grouped(tables, by, order, make, columns, f"{order} bigint, _last bigint")


def _joined(a: DataFrame, b: DataFrame, keys: list[str], take: str) -> DataFrame:
    names = [f"_k{i}" for i in range(len(keys))]
    right = b.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), take)
    same: list[Column] = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return a.join(right, same).drop(*names)


def kept_times(times: DataFrame, by: list[str], t: str, interval: int) -> DataFrame:
    """The rows (``by``, ``t``, distinct) that are kept: each an interval after the last one of its key that is."""
    bucket = F.floor(F.col(t) / (interval * SPAN)).cast("bigint")
    dealt = times.where(F.col(t).isNotNull()).select(*by, F.col(t).cast("bigint").alias("_t"), bucket.alias("_bucket"))
    dealt = dealt.withColumn("_group", F.floor(F.col("_bucket") / SPAN).cast("bigint"))
    tables = bucket_tables(dealt, by, interval)
    before_group = states(group_tables(tables, by, interval), by, "_group", interval)
    inside = _joined(tables, before_group, [*by, "_group"], "_last").withColumnRenamed("_last", "_begin")
    before = states(inside, [*by, "_group"], "_bucket", interval, "_begin")

    def make(_: tuple, rows: pa.Table) -> Iterator[tuple]:
        place, last = rows["_t"].to_numpy(), rows["_last"][0].as_py()
        first = 0 if last == NEVER else int(np.searchsorted(place, last + interval))
        if first < len(place):
            yield from ((int(x),) for x in place[chain(jumps(place, interval), first)])

    full = [*by, "_group", "_bucket"]
    asked = _joined(dealt, before, full, "_last")
    kind = dict(times.dtypes)[t]
    return _grouped(asked, full, "_t", make, ["_t", "_last"], "_kept bigint").select(*by, F.col("_kept").cast(kind).alias(t))
