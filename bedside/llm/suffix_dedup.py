"""Removal of repeated byte strings by prefix doubling over sampled positions (operator 1).

Every byte that a string of ``length`` bytes covers which also starts elsewhere goes,
same document included. Ranking all positions would shuffle each byte's position
and rank several times over; so positions are sampled by content first:

1. Ranks are fingerprints that grow by doubling: the one of 2h bytes at a position
   joins those of h bytes there and h bytes further on. Of all ``GRAM``-byte
   fingerprints in a window of ``length`` bytes the least one is the window's anchor.
   Equal windows have equal anchors at equal places, so a window whose anchor is
   unique in the corpus is unique. Spark groups the anchors by rank and drops unique ones.
2. The others are ranked anew at a longer extent: all the windows that an anchor
   stands for. Where all anchors of a rank agree in it, all those windows repeat.
3. What is left (edges of repeats) is ranked past the threshold: the fingerprint of
   each whole window, once per distinct extent. Extents of an anchor are ranked in one
   task; where they are very many, Spark counts their windows' fingerprints instead.
4. Windows that repeat become spans of their documents.

``doubled_spans`` is the plain form: rank pairs of all positions, sorted in Spark at
growing offsets. It gives the same spans and shuffles some 60 times its input.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing;
repeated rows are copies of each other and lose all, if long enough; a null doc_id is
kept as it is; an empty table gives no rows; input columns named like the result's own
(kept, n_bytes, n_removed, n_spans) give way to these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedside.llm.common import remove_written, slices, written

LENGTH = 200
#: Bytes of an anchor's fingerprint: a power of two.
GRAM = 64
#: Bytes that are ranked at a time; positions are packed in 20 bits.
PIECE, PACKED = 1 << 18, 20
#: Anchors of more distinct extents than this aren't gathered in one task.
MANY = 4_096
#: Window fingerprints in one batch, about.
MARKS = 200_000
#: Extents whose windows are ranked at a time.
EXTENTS = 10_000
ANCHORS = "gram bigint, extent bigint, row_key bigint, pos bigint, low int, high int"


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One fingerprint from those of two neighbouring strings."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def grams(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Fingerprints of ``size`` bytes at each position (the last ones reach into padding)."""
    n = len(data)
    padded = np.zeros(n + size + 8, dtype=np.uint8)
    padded[:n] = data
    h = np.ndarray((n + size,), "<u8", padded, 0, (1,)).astype(np.uint64)
    width = 8
    while width < size:
        h = joined(h[:-width], h[width:])
        width *= 2
    return h[:n]


def fingerprint(h: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of strings of ``sizes`` >= GRAM at ``at``, from overlapping grams that cover them."""
    out = h[at] ^ sizes.astype(np.uint64)
    for step in range(GRAM, int(sizes.max(initial=0)), GRAM):
        out = joined(out, h[at + np.minimum(step, sizes - GRAM)])
    return out


def least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of each window of ``width`` values, the first one of equal ones."""
    mask = np.uint64((1 << PACKED) - 1)
    m = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        m = np.minimum(m[:-reach], m[reach:])
        reach *= 2
    if reach < width:
        m = np.minimum(m[: len(m) - (width - reach)], m[width - reach :])
    return (m & mask).astype(np.int64)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)), bounds


def pieces(bounds: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (row, from, to) of about PIECE bytes; long texts are cut so that each window is in one part."""
    held, size = [], 0
    for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        at = a
        while b - at >= length:
            to = min(b, at + PIECE)
            held.append((row, at, to))
            size += to - at
            at = to - length + 1 if to < b else b
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def anchors(data: np.ndarray, bounds: np.ndarray, row_keys: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    for part in pieces(bounds, length):
        text = np.concatenate([data[a:b] for _, a, b in part])
        h = grams(text)
        owner = least_in_windows(h, length - GRAM + 1)
        sizes = np.array([b - a for _, a, b in part])
        begins = np.r_[0, np.cumsum(sizes)[:-1]]
        counts = sizes - length + 1
        windows = np.arange(counts.sum()) + np.repeat(begins - np.r_[0, np.cumsum(counts)[:-1]], counts)
        own = owner[windows]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        last = np.r_[first[1:] - 1, len(own) - 1]
        at, start, end = own[first], windows[first], windows[last]
        low, high = at - end, at - start
        which = np.searchsorted(begins, at, side="right") - 1
        rows = np.array([r for r, _, _ in part])[which]
        pos = at - begins[which] + np.array([a for _, a, _ in part])[which] - bounds[rows]
        extent = joined(fingerprint(h, start, end - start + length), (low * 256 + high).astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h[at].view(np.int64), extent.view(np.int64), row_keys[rows], pos, low.astype(np.int32), high.astype(np.int32))], names=["gram", "extent", "row_key", "pos", "low", "high"])


def anchor_table(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch["text"])
            yield from anchors(data, bounds, batch["row_key"].to_numpy(), length)

    return docs.mapInArrow(run, ANCHORS)


def extents(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted extents: key, gram, extent, low, high, bytes. ``wanted``: one row of the corpus for each extent.

    Extents of an anchor of many have a row for each window instead: its fingerprint
    as key, its offset as low and high, and no bytes.
    """
    names = ("key", "gram", "extent", "low", "high", "bytes")

    def made(columns: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    def windows(marks: list[tuple]) -> pa.RecordBatch:
        key, gram, extent, offset = (np.concatenate(c) for c in zip(*marks))
        return made([key, gram, extent, offset, offset, [None] * len(key)])

    # Copies under one key give an extent once; partial aggregation reduces them before the exchange.
    one = docs.groupBy("row_key").agg(F.first("text").alias("text"))
    per_row = wanted.groupBy("row_key").agg(F.collect_list(F.struct("gram", "extent", "pos", "low", "high", "many")).alias("wanted"))
    rows = one.join(per_row, "row_key").select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            data, bounds = text_buffers(batch["text"])
            out: list[tuple] = []
            marks: list[tuple] = []
            n_marks = 0
            for row, items in enumerate(batch["wanted"].to_pylist()):
                text = data[bounds[row] : bounds[row + 1]]
                for w in items:
                    low, high = w["low"], w["high"]
                    part = text[w["pos"] - high : w["pos"] - low + length]
                    if not w["many"]:
                        out.append((w["gram"], w["gram"], w["extent"], low, high, part.tobytes()))
                        continue
                    n = high - low + 1
                    mark = fingerprint(grams(part), np.arange(n), np.full(n, length)).view(np.int64)
                    marks.append((mark, np.full(n, w["gram"]), np.full(n, w["extent"]), np.arange(high, low - 1, -1, dtype=np.int32)))
                    n_marks += n
                    if n_marks >= MARKS:
                        yield windows(marks)
                        marks, n_marks = [], 0
            if out:
                yield made(list(zip(*out)))
            if marks:
                yield windows(marks)

    return rows.mapInArrow(run, "key bigint, gram bigint, extent bigint, low int, high int, bytes binary")


def repeated_offsets(rows: DataFrame, length: int) -> DataFrame:
    """gram, extent and runs (low, high) of offsets whose windows occur in another extent of the same key."""

    def settle(held: list[tuple]) -> pa.RecordBatch | None:
        held = list(dict.fromkeys(held))
        data = np.frombuffer(b"".join(r[5] for r in held), np.uint8)
        sizes = np.array([len(r[5]) for r in held])
        begins = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        first = np.cumsum(counts) - counts
        which = np.repeat(np.arange(len(held)), counts)
        at = np.arange(counts.sum()) - first[which] + begins[which]
        marks = fingerprint(grams(data), at, np.full(len(at), length))
        order = np.argsort(marks, kind="stable")
        ranked = marks[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        # Runs of repeated windows within an extent; its first window has the highest offset.
        edge = np.r_[True, which[1:] != which[:-1]]
        begin = np.flatnonzero(twice & (edge | ~np.r_[False, twice[:-1]]))
        end = np.flatnonzero(twice & np.r_[edge[1:] | ~twice[1:], True])
        if not len(begin):
            return None
        row = which[begin]
        top = np.array([r[4] for r in held])[row]
        return pa.RecordBatch.from_arrays(
            [pa.array([held[i][1] for i in row], pa.int64()), pa.array([held[i][2] for i in row], pa.int64()), pa.array((top - (end - first[row])).astype(np.int32)), pa.array((top - (begin - first[row])).astype(np.int32))],
            names=["gram", "extent", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches, "bytes"):
            for row in zip(*(batch[n].to_pylist() for n in ("key", "gram", "extent", "low", "high", "bytes"))):
                if len(held) >= EXTENTS and row[0] != held[-1][0]:
                    if (out := settle(held)) is not None:
                        yield out
                    held = []
                held.append(row)
        if held and (out := settle(held)) is not None:
            yield out

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "gram bigint, extent bigint, low int, high int")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """As ``repeated_offsets`` for rows of one window each: fingerprints are counted, and none is gathered under its key."""
    counted = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("extent").alias("a"), F.max("extent").alias("b"))
    twice = written(counted.where("a < b").select("key", "n"), "twice")
    # There are at most 1 / MANY as many common fingerprints as rows.
    common = F.broadcast(twice.where(F.col("n") > MANY).select("key"))
    others = rows.join(common, "key", "left_anti").join(twice.where(F.col("n") <= MANY).select("key"), "key", "left_semi")
    found = rows.join(common, "key", "left_semi").unionByName(others).select("gram", "extent", "low")
    # Neighbouring offsets of an extent have the same difference from their rank.
    rank = F.row_number().over(Window.partitionBy("gram", "extent").orderBy("low"))
    runs = found.withColumn("run", F.col("low") - rank).groupBy("gram", "extent", "run").agg(F.min("low").alias("low"), F.max("low").alias("high"))
    return runs.select("gram", "extent", "low", "high")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row_key, start, end (bytes) of repeated windows, joined within an anchor. ``docs``: row_key, text."""
    table = written(anchor_table(docs, length), "anchors")
    ranks = table.groupBy("gram").agg(F.count("*").alias("n"), F.min("extent").alias("a"), F.max("extent").alias("b"))
    ranks = written(ranks.where("n > 1").select("gram", (F.col("a") == F.col("b")).alias("same")), "ranks")
    again = written(table.join(ranks, "gram"), "again")
    remove_written(table, ranks)
    settled = again.where("same").select("row_key", "pos", "low", "high")
    mixed = again.where("NOT same").drop("same")
    kinds = mixed.groupBy("gram", "extent").agg(F.count("*").alias("n"), F.min(F.struct("row_key", "pos", "low", "high")).alias("one"))
    kinds = written(kinds.select("gram", "extent", "n", "one.*"), "extents")
    many = written(kinds.groupBy("gram").count().where(F.col("count") > MANY).select("gram", F.lit(True).alias("many")), "many")
    wanted = kinds.join(many, "gram", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    ranked = extents(docs, wanted, length)
    if many.isEmpty():
        edges = repeated_offsets(ranked, length)
    else:
        ranked = written(ranked, "ranked")
        edges = repeated_offsets(ranked.where("bytes IS NOT NULL"), length).unionByName(repeated_windows(ranked.where("bytes IS NULL")))
    copies = kinds.where("n > 1").select("gram", "extent", "low", "high")
    offsets = written(edges.unionByName(copies), "offsets")
    remove_written(kinds, many)
    found = mixed.select("gram", "extent", "row_key", "pos").join(offsets, ["gram", "extent"]).select("row_key", "pos", "low", "high")
    return settled.unionByName(found).select("row_key", (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + length).alias("end"))


def gram_positions(docs: DataFrame, size: int) -> DataFrame:
    """row_key, pos and fingerprint of every string of ``size`` bytes, a power of two from 8 to GRAM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            data, bounds = text_buffers(batch["text"])
            for key, a, b in zip(batch["row_key"].to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                for at in range(a, b - size + 1, PIECE):
                    h = grams(data[at : min(b, at + PIECE + size - 1)], size)
                    h = h[: len(h) - size + 1]
                    pos = np.arange(len(h), dtype=np.int32) + np.int32(at - a)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), key)), pa.array(pos), pa.array(h.view(np.int64))], names=["row_key", "pos", "rank"])

    return docs.mapInArrow(run, "row_key bigint, pos int, rank bigint")


def ranked_again(pairs: DataFrame) -> DataFrame:
    """New ranks of the pairs (rank, further) that occur more than once, by one sort in Spark; unique ones go.

    Equal pairs meet in one range of the sort, which a task passes once in order: it
    holds a batch and the pair before it, whatever the number of equal pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, n = np.int64(TaskContext.get().partitionId()) << np.int64(40), 0
        before: np.ndarray | None = None  # last row that isn't settled: row_key, pos, rank, further
        repeated = False  # it equals the row before it
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("row_key", "pos", "rank", "further")])
            if before is not None:
                rows = np.concatenate([before[:, None], rows], axis=1)
            same = (rows[2:, 1:] == rows[2:, :-1]).all(axis=0)
            first = np.r_[repeated, same[:-1]] if rows.shape[1] > 1 else np.zeros(0, dtype=bool)
            number = n + np.cumsum(np.r_[0, ~same])
            keep = first | same
            done = rows[:, :-1][:, keep]
            if done.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(done[0]), pa.array(done[1].astype(np.int32)), pa.array(base + number[:-1][keep])], names=["row_key", "pos", "rank"])
            before, n = rows[:, -1], int(number[-1])
            repeated = bool(same[-1]) if len(same) else repeated
        if before is not None and repeated:
            yield pa.RecordBatch.from_arrays([pa.array(before[:1]), pa.array(before[1:2].astype(np.int32)), pa.array([base + n])], names=["row_key", "pos", "rank"])

    laid = pairs.repartitionByRange("rank", "further").sortWithinPartitions("rank", "further")
    return laid.mapInArrow(run, "row_key bigint, pos int, rank bigint")


def doubled_spans(docs: DataFrame, length: int = LENGTH, start: int = GRAM) -> DataFrame:
    """As ``repeated_spans``, by prefix doubling over every position.

    Pairs of ranks at growing offsets are sorted and ranked anew until strings of
    ``length`` bytes are ranked; a position goes once its rank is unique, and with it
    every string that holds it further on. Needs no anchors, but each round shuffles
    all positions left: for tables of some gigabytes and as a check on the sampled way.
    """
    # Rows of one key are copies: one is ranked, and all lose the whole text.
    one = docs.groupBy("row_key").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    size = F.octet_length("text")
    copies = one.where("n > 1").where(size >= length).select("row_key", F.lit(0).alias("start"), size.alias("end"))
    at = gram_positions(one, start)
    ranks = written(ranked_again(at.withColumn("further", F.lit(0).cast("bigint"))), "doubled")
    size = start
    while size < length:
        step = min(size, length - size)
        further = ranks.select("row_key", (F.col("pos") - step).alias("pos"), F.col("rank").alias("further"))
        longer = written(ranked_again(ranks.join(further, ["row_key", "pos"])), "doubled")
        remove_written(ranks)
        ranks, size = longer, size + step
    run = F.col("pos") - F.row_number().over(Window.partitionBy("row_key").orderBy("pos"))
    runs = ranks.withColumn("run", run).groupBy("row_key", "run").agg(F.min("pos").alias("start"), (F.max("pos") + length).alias("end"))
    return runs.select("row_key", "start", "end").unionByName(copies)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that the spans cover."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    return starts[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(reach) - 1]]


def remove_repeats(docs: DataFrame, length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """All columns of ``docs`` plus kept (the remaining bytes), n_bytes, n_removed and n_spans.

    With ``as_text`` kept is a string; bytes of a character that a cut parted are dropped.
    """
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans", "row_key", "spans")
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(keyed.select("row_key", F.coalesce("text", F.lit("")).alias("text")), length)
    per_row = spans.groupBy("row_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = keyed.join(per_row, "row_key", "left").drop("row_key")
    columns, kinds = docs.columns, dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            data, bounds = text_buffers(batch["text"])
            spans = batch["spans"]
            counts = np.diff(np.asarray(spans.offsets))
            inner = spans.flatten()
            starts, ends = (inner.field(i).to_numpy() for i in (0, 1))
            at = np.r_[0, np.cumsum([0 if not v else c for v, c in zip(spans.is_valid().to_pylist(), counts)])]
            kept, removed, runs = [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                text = data[a:b].tobytes()
                if at[i] == at[i + 1]:
                    kept.append(text)
                    removed.append(0)
                    runs.append(0)
                    continue
                s, e = merged(starts[at[i] : at[i + 1]], ends[at[i] : at[i + 1]])
                kept.append(b"".join([text[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(text)])]))
                removed.append(int((e - s).sum()))
                runs.append(len(s))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()), pa.array(np.diff(bounds)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())], names=[*columns, "kept", "n_bytes", "n_removed", "n_spans"])

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), f"kept {'string' if as_text else 'binary'}, n_bytes bigint, n_removed bigint, n_spans bigint"]))


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (doc_id, text, n_chars and others) with texts cut to what is kept, and n_chars to match."""
    plain = {c: c if c in ("doc_id", "text", "n_chars") else f"_c{i}" for i, c in enumerate(docs.columns)}
    out = remove_repeats(docs.toDF(*plain.values()), length, as_text=True)
    cut = F.col("n_removed") > 0
    changed = {"text": F.when(cut, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in plain:
        changed["n_chars"] = F.when(cut, F.length("kept")).otherwise(F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"])
    return out.withColumns(changed).select(*(F.col(p).alias(c) for c, p in plain.items()))
