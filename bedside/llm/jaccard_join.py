"""N-gram Jaccard self-join by a prefix tree, and its components (operator 9).

A document's set holds the hashes of its distinct word n-grams, in the order of the
hashes, which is the same for all documents. Two sets link when
100 * intersection >= threshold * union.

1. Equal sets are one node from the start.
2. Candidates: two linked sets of a size class differ in at most k elements. Cut the
   hash range into k + 1 + spare ranges: at least 1 + spare of them hold the same
   elements in both. Sets that agree in a whole range meet under its key. This holds
   for every linked pair, and agreement in a whole range is rare among others, however
   common a single n-gram is.
3. Verification: each key's least set is its pivot, and pairs of a pivot with its sets
   are checked against the texts: first each set with the pivot it shares most keys
   with, then the pairs whose components still differ. Pairs whose bit maps show too
   many elements that aren't common are left out beforehand. A task stores the sets of one pivot in a prefix tree
   (sorted, each sharing its beginning with the one before) and walks it with the
   pivot's set: overlaps of shared beginnings are counted once, and a subtree ends
   where the elements missing so far leave too few for the threshold. Pivots of many
   sets are dealt to many tasks.
4. Components. Keys whose remaining sets lie in one component are settled. Sets that
   share other keys, and whose bit maps don't rule it out, form groups, dealt into blocks; each pair of blocks is one more
   task that walks a prefix tree with every set whose component still differs. So each
   pair under a key is checked or lies in one component: no link is lost, and no
   group's pairs are listed as rows.

Defined cases: null and blank texts have an empty set and link with nothing; texts of
fewer than n words have their whole sequence as the one element; repeated rows are
equal sets; a null doc_id joins its component but never names it; an empty table
gives no rows; extra columns aren't read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside.llm.common import WORD_PATTERN, map_text, remove_written, slices, written
from bedside.llm.components import components

WORDS_HELD = 200_000
#: Sets of one cell: what a pivot is compared with, or a block of a group, about.
BUCKET_SETS = 256
#: Sets of one key whose bit maps meet in one task, about.
MAP_BLOCK = 1_024
#: Elements that a walk looks up at a time.
WALK = 32


class Shingler:
    """Sorted arrays of n-gram hashes; a task builds one."""

    def __init__(self, n: int, fold_case: bool = True):
        self.n, self.fold_case = n, fold_case
        self.hashes = WordHashes()

    def __call__(self, text: str) -> np.ndarray:
        data = text.encode("utf-8", "surrogatepass")
        # On bytes, lower() and split() know just A-Z and the six white-space characters.
        words = (data.lower() if self.fold_case else data).split()
        if len(self.hashes) > WORDS_HELD:
            self.hashes.clear()
        h = np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.n, len(h))
        if not width:
            return h
        out = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
        out.sort()
        return out[np.r_[True, out[1:] != out[:-1]]]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word (a public 64-bit finaliser)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Classes:
    """Size classes: class c holds pairs whose smaller set has a size from bounds[c] to below bounds[c + 1]."""

    def __init__(self, threshold: int):
        self.threshold = threshold
        self.bounds = [1]

    def of(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(max(self.bounds[-1] + 1, self.bounds[-1] * 5 // 4))
        return bisect_right(self.bounds, size) - 1

    def joined_by(self, size: int) -> list[int]:
        """The classes of a set as the smaller and as the larger one of a pair."""
        low = self.of(-(-size * self.threshold // 100))
        high = self.of(size)
        return list(range(low, high + 1))

    def ranges(self, c: int) -> tuple[int, int]:
        """Ranges of a class, and how many of them agree in linked sets at least."""
        self.of(self.bounds[c])
        most = self.bounds[c + 1] - 1
        both = most + most * 100 // self.threshold
        k = both * (100 - self.threshold) // (100 + self.threshold)
        spare = min(k, 3)
        return k + 1 + spare, 1 + spare


def range_keys(s: np.ndarray, classes: Classes) -> np.ndarray:
    """Keys of a set: one per class and range."""
    sums = np.r_[np.uint64(0), np.cumsum(mixed(s ^ np.uint64(0xD6E8FEB86659FD93)))]
    out = []
    for c in classes.joined_by(len(s)):
        m, agree = classes.ranges(c)
        cuts = np.searchsorted(s >> np.uint64(32), (np.arange(1, m, dtype=np.uint64) << np.uint64(32)) // np.uint64(m))
        cuts = np.r_[0, cuts, len(s)]
        held = sums[cuts[1:]] - sums[cuts[:-1]]
        which = np.arange(m, dtype=np.uint64)
        full = cuts[1:] > cuts[:-1]
        if m - full.sum() < agree:  # then some range that agrees isn't empty
            held, which = held[full], which[full]
        out.append(mixed(mixed(held) + which * np.uint64(0x9E3779B97F4A7C15) + np.uint64(c + 1)))
    return np.concatenate(out).view(np.int64)


def needed(a: int, b: int, threshold: int) -> int:
    """Common elements that sets of these sizes need."""
    return -(-threshold * (a + b) // (100 + threshold))


class PrefixTree:
    """Sets in lexicographic order, each sharing its beginning with the one before: a prefix tree, walked depth first."""

    def __init__(self, sets: list[np.ndarray], threshold: int):
        self.threshold = threshold
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            most = min(len(a), len(b))
            differs = np.flatnonzero(a[:most] != b[:most])
            self.shared.append(int(differs[0]) if len(differs) else most)

    def matches(self, probe: np.ndarray, wanted=None) -> list[int]:
        """Numbers of the (wanted) sets that link with ``probe``.

        Overlaps of a beginning that several sets share are counted once; a set is
        left as soon as more of its elements are missing than the threshold allows.
        """
        found: list[int] = []
        common = np.zeros(1, dtype=np.int64)  # common[d]: of the walked set's first d elements, those the probe has
        depth = 0  # how deep the set at hand agrees with the walked one
        top = len(probe) - 1
        for i, s, shared in zip(self.order, self.sets, self.shared):
            depth = min(depth, shared)
            if wanted is not None and not wanted[i]:
                continue
            need = needed(len(probe), len(s), self.threshold)
            if need > min(len(probe), len(s)):
                continue
            common, at = common[: depth + 1], depth
            pieces = [common]
            got = int(common[-1])
            spare = len(s) - need  # elements that may be missing
            while at < len(s) and at - got <= spare:
                step = s[at : at + WALK]
                place = np.searchsorted(probe, step)
                np.minimum(place, top, out=place)
                counts = np.cumsum(probe[place] == step)
                counts += got
                pieces.append(counts)
                got, at = int(counts[-1]), at + len(step)
            common, depth = np.concatenate(pieces), at
            if at == len(s) and got >= need:
                found.append(i)
        return found


def tree_matches(probe: np.ndarray, sets: list[np.ndarray], threshold: int) -> list[int]:
    return PrefixTree(sets, threshold).matches(probe)


def linked_pairs(sets: list[np.ndarray], sides: list[int], roots: list[int], threshold: int) -> list[tuple[int, int]]:
    """Links that join components, between sets of side 0 and side 1; with one side only, within it.

    ``roots`` names the components known before; a pair in one component isn't compared.
    """
    number: dict[int, int] = {}
    part = np.array([number.setdefault(r, len(number)) for r in roots])
    side = np.array(sides)
    both = len(set(sides)) > 1
    tree = PrefixTree(sets, threshold)
    out = []
    for i, s in enumerate(sets):
        if both and side[i]:
            continue
        wanted = part != part[i]
        wanted &= (side == 1) if both else (np.arange(len(sets)) > i)
        if not wanted.any():
            continue
        for j in tree.matches(s, wanted):
            if part[i] != part[j]:
                part[part == part[j]] = part[i]
                out.append((i, j))
    return out


def bit_map(s: np.ndarray) -> np.ndarray:
    """Which low bits of the hashes occur: 2 to 4 bits an element, a power of two of them, 64 at least."""
    size = max(64, 1 << (2 * len(s) - 1).bit_length())
    bits = np.zeros(size, dtype=bool)
    bits[(s & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def may_link(a: Column, n: Column, b: Column, m: Column, threshold: int) -> Column:
    """False only if the bit maps of two sets of sizes n and m show that they can't link.

    A bit that one set has and the other hasn't stands for an element that isn't common.
    The longer map is folded to the length of the shorter.
    """

    def folded(x: Column, y: Column) -> Column:
        half = F.floor(F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseOR(q))).otherwise(x)

    def alone(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda t, k: t + k)

    x, y = folded(a, b), folded(b, a)
    # Sizes within a quarter differ by one doubling at most; other lengths aren't judged.
    judged = F.size(x) == F.size(y)
    most = F.least(n - alone(x, y), m - alone(y, x))
    return F.when(judged, (100 + threshold) * most >= threshold * (n + m)).otherwise(100 * F.least(n, m) >= threshold * F.greatest(n, m))


def row_key() -> Column:
    """Equal for rows of equal doc_id and text."""
    return F.xxhash64("doc_id", "text")


def shingle_table(docs: DataFrame, n: int, threshold: int) -> DataFrame:
    """doc_id, row_key, n_shingles, set_id (null for empty sets), the set's bit map and keys."""

    def make() -> Callable[[list[str]], dict[str, pa.Array]]:
        shingles, classes = Shingler(n), Classes(threshold)

        def work(texts: list[str]) -> dict[str, pa.Array]:
            sets = [shingles(t) for t in texts]
            keys = [range_keys(s, classes) if len(s) else np.zeros(0, np.int64) for s in sets]
            ids = [set_id(s) if len(s) else None for s in sets]
            offsets = np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32)
            maps = [bit_map(s) if len(s) else np.zeros(0, np.int64) for s in sets]
            ends = np.r_[0, np.cumsum([len(m) for m in maps])].astype(np.int32)
            return {
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "set_id": pa.array(ids, pa.int64()),
                "bits": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(maps), pa.int64())),
                "keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys), pa.int64())),
            }

        return work

    keyed = docs.select("doc_id", "text", row_key().alias("row_key"))
    return map_text(keyed, ["doc_id", "row_key"], "text", make, "n_shingles bigint, set_id bigint, bits array<bigint>, keys array<bigint>")


def set_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def texts_of(sets: DataFrame, table: DataFrame, docs: DataFrame) -> DataFrame:
    """set_id and a text that has this set, from one row for each; one with a doc_id if there is any."""
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.col("row_key")))
    rows = table.where("set_id IS NOT NULL").groupBy("set_id").agg(least.alias("named"), F.min("row_key").alias("any"))
    one = rows.join(sets, "set_id").select("set_id", F.coalesce("named", "any").alias("row_key"), F.col("named").isNotNull().alias("has_id"))
    keyed = docs.select("doc_id", "text", row_key().alias("row_key"))
    named = keyed.where("doc_id IS NOT NULL").join(one.where("has_id"), "row_key").select("set_id", "text")
    # Copies without a doc_id can be many under one key: one of each partition is dealt.
    unnamed = keyed.where("doc_id IS NULL").groupBy("row_key").agg(F.min("text").alias("text")).join(one.where("NOT has_id"), "row_key").select("set_id", "text")
    return written(named.unionByName(unnamed), "texts")


def walked(cells: DataFrame, texts: DataFrame, n: int, threshold: int, pivoted: bool) -> DataFrame:
    """Links (a, b) found in each cell. ``cells``: cell, set_id, side, root.

    With ``pivoted`` side 0 is the pivot alone. A cell's sets are bounded in number.
    """
    rows = cells.join(texts, "set_id").select("cell", "set_id", "side", "root", "text")

    def settle(shingles: Shingler, held: list[tuple]) -> list[tuple[int, int]]:
        known: dict[int, tuple] = {}
        for _, i, side, root, text in held:
            if i not in known:
                s = shingles(text or "")
                if set_id(s) == i:  # another row may have the same key
                    known[i] = (s, side, root)
        ids = list(known)
        sets, sides, roots = ([known[i][k] for i in ids] for k in range(3))
        if pivoted and 0 not in sides:
            return []
        return [(ids[i], ids[j]) for i, j in linked_pairs(sets, sides, roots, threshold)] if sets else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        held: list[tuple] = []
        for batch in slices(batches, "text"):
            out: list[tuple[int, int]] = []
            for row in zip(*(batch[c].to_pylist() for c in ("cell", "set_id", "side", "root", "text"))):
                if held and held[-1][0] != row[0]:
                    out += settle(shingles, held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pydict({"a": [x for x, _ in out], "b": [x for _, x in out]})
        if held and (out := settle(shingles, held)):
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in out], "b": [x for _, x in out]})

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def pivot_links(pairs: DataFrame, table: DataFrame, docs: DataFrame, n: int, threshold: int) -> DataFrame:
    """The linked ones of ``pairs`` (pivot, other); a pivot of many sets is dealt to many cells."""
    pairs = written(pairs, "pairs")
    size = written(pairs.groupBy("pivot").count().select("pivot", (F.floor(F.col("count") / BUCKET_SETS) + 1).alias("buckets")), "sizes")
    zero = F.lit(0).cast("long")
    others = pairs.join(size, "pivot").select("pivot", F.col("other").alias("set_id"), F.lit(1).alias("side"), F.pmod(F.xxhash64("other"), F.col("buckets")).alias("bucket"))
    own = size.select("pivot", F.col("pivot").alias("set_id"), F.lit(0).alias("side"), F.explode(F.sequence(zero, F.col("buckets") - 1)).alias("bucket"))
    cells = others.unionByName(own).select(F.xxhash64("pivot", "bucket").alias("cell"), "set_id", "side", F.col("set_id").alias("root"))
    texts = texts_of(pairs.select(F.explode(F.array("pivot", "other")).alias("set_id")).distinct(), table, docs)
    links = written(walked(cells, texts, n, threshold, True), "links")
    remove_written(texts, size, pairs)
    return links


def possible_in_cell(roots: np.ndarray, sizes: np.ndarray, maps: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """Edges that tie together sets of different components which their bit maps let link; no more than there are sets."""
    part = np.arange(len(sizes))
    out: list[tuple[int, int]] = []
    lengths = np.array([len(m) for m in maps])
    for length in np.unique(lengths).tolist():
        here, twice = np.flatnonzero(lengths == length), np.flatnonzero(lengths == 2 * length)
        near = np.r_[here, twice]
        if len(near) < 2:
            continue
        y = np.stack([maps[i] if lengths[i] == length else maps[i][:length] | maps[i][length:] for i in near]).view(np.uint64)
        occurs = np.bitwise_count(y).sum(axis=1, dtype=np.int64)
        rows = max(1, 2_000_000 // (len(near) * length))
        for at in range(0, len(here), rows):
            x = slice(at, min(at + rows, len(here)))
            common = np.bitwise_count(y[x, None, :] & y[None, :, :]).sum(axis=2, dtype=np.int64)
            most = np.minimum((sizes[near[x]] - occurs[x])[:, None], (sizes[near] - occurs)[None, :]) + common
            ok = (100 + threshold) * most >= threshold * (sizes[near[x]][:, None] + sizes[near][None, :])
            ok &= roots[near[x]][:, None] != roots[near][None, :]
            for i, row in zip(near[x].tolist(), ok):
                hits = near[row]
                for part_of in np.unique(part[hits]).tolist():
                    if part_of != part[i]:
                        out.append((i, int(hits[part[hits] == part_of][0])))
                        part[part == part_of] = part[i]
    return out


def possible_edges(left: DataFrame, table: DataFrame, threshold: int) -> DataFrame:
    """Sets under one open key that may link though their components differ, as edges (a, b) of a forest per key.

    A key of many sets is dealt into blocks, and each pair of blocks is a task's cell.
    """
    maps = table.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min(F.struct("n_shingles", "bits")).alias("map"))
    size = left.groupBy("key").count().select("key", (F.floor(F.col("count") / MAP_BLOCK) + 1).alias("blocks"))
    dealt = left.join(written(size, "blocks"), "key").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    each = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = each.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "set_id", "root")
    rows = cells.join(maps, "set_id").select("cell", "set_id", "root", F.col("map.n_shingles").alias("size"), "map.bits")

    def settle(held: list[tuple]) -> list[tuple[int, int]]:
        known = {r[1]: r for r in held}
        ids = list(known)
        if len(ids) < 2:
            return []
        roots, sizes = (np.array([known[i][k] for i in ids]) for k in (2, 3))
        maps = [np.array(known[i][4], dtype=np.int64) for i in ids]
        return [(ids[i], ids[j]) for i, j in possible_in_cell(roots, sizes, maps, threshold)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches, "bits"):
            out: list[tuple[int, int]] = []
            for row in zip(*(batch[c].to_pylist() for c in ("cell", "set_id", "root", "size", "bits"))):
                if held and held[-1][0] != row[0]:
                    out += settle(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pydict({"a": [x for x, _ in out], "b": [x for _, x in out]})
        if held and (out := settle(held)):
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in out], "b": [x for _, x in out]})

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def group_links(members: DataFrame, roots: DataFrame, table: DataFrame, docs: DataFrame, n: int, threshold: int) -> DataFrame | None:
    """Links among sets whose keys aren't settled; None if all are. ``members``: key, set_id without each key's pivot.

    Sets that share such a key and that their bit maps let link are tied together; the
    components of these ties are groups. A group's sets are dealt into blocks, and each
    pair of blocks is a cell: every pair that may link meets once, however many keys it
    shares, and is compared only if its components still differ.
    """
    labelled = members.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").select("key", "set_id", F.coalesce("root", "set_id").alias("root"))
    open_keys = labelled.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.min("set_id").alias("least")).where("a < b").select("key", "least")
    open_keys = written(open_keys, "open")
    left = written(labelled.join(open_keys, "key"), "left")
    remove_written(open_keys)
    if left.isEmpty():
        remove_written(left)
        return None
    edges = written(possible_edges(left, table, threshold), "maybe")
    if edges.isEmpty():
        remove_written(left, edges)
        return None
    group = components(edges)
    sets = edges.select(F.explode(F.array("a", "b")).alias("set_id")).distinct().join(left.select("set_id", "root").distinct(), "set_id")
    grouped = written(sets.join(group.withColumnRenamed("node", "set_id").withColumnRenamed("root", "group"), "set_id", "left").withColumn("group", F.coalesce("group", "set_id")), "grouped")
    blocks = written(grouped.groupBy("group").count().select("group", (F.floor(F.col("count") / BUCKET_SETS) + 1).alias("blocks")), "blocks")
    dealt = grouped.join(blocks, "group").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    each = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    cells = each.select(F.xxhash64("group", low, high).alias("cell"), "set_id", F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "root")
    texts = texts_of(grouped.select("set_id"), table, docs)
    links = written(walked(cells, texts, n, threshold, False), "links")
    remove_written(texts, blocks, grouped, left, edges)
    return links


def possible_pairs(members: DataFrame, table: DataFrame, threshold: int) -> DataFrame:
    """pivot, other and the number of keys they share, without pairs that their bit maps rule out."""
    shared = members.groupBy("pivot", F.col("set_id").alias("other")).agg(F.count("*").alias("n_keys"))
    maps = table.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min(F.struct("n_shingles", "bits")).alias("map"))
    for end in ("pivot", "other"):
        shared = shared.join(maps.select(F.col("set_id").alias(end), F.col("map").alias(f"{end}_map")), end)
    a, b = F.col("pivot_map"), F.col("other_map")
    return written(shared.where(may_link(a["bits"], a["n_shingles"], b["bits"], b["n_shingles"], threshold)).select("pivot", "other", "n_keys"), "possible")


def extended(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) with further links; known components are single nodes of the new graph."""
    if links.isEmpty():
        return roots
    ends = links
    for end in ("a", "b"):
        up = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        ends = ends.join(up, end, "left").withColumn(end, F.coalesce(f"{end}_root", end)).drop(f"{end}_root")
    later = components(ends)
    joined = roots.join(later.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(joined.unionByName(later.join(roots.select("node"), "node", "left_anti")), "roots")


def linked_rows(docs: DataFrame, n: int, threshold: int) -> DataFrame:
    """doc_id, row_key, n_shingles, set_id and root (of the set's component; null for empty sets) of each row."""
    table = written(shingle_table(docs, n, threshold), "sets")
    spread = table.where("set_id IS NOT NULL").select(F.explode("keys").alias("key"), "set_id")
    keys = written(spread.groupBy("key").agg(F.min("set_id").alias("pivot"), F.max("set_id").alias("last")).where("pivot < last").select("key", "pivot"), "keys")
    members = written(spread.join(keys, "key").where("set_id <> pivot").distinct(), "members")
    pairs = all_pairs = possible_pairs(members, table, threshold)
    # Most sets link with the pivot that they share most keys with; that settles most other pairs.
    best = pairs.groupBy(F.col("other")).agg(F.max_by("pivot", F.struct("n_keys", "pivot")).alias("pivot"))
    roots = components(pivot_links(best.select("pivot", "other"), table, docs, n, threshold))
    for end in ("pivot", "other"):
        up = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        pairs = pairs.join(up, end, "left").withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
    apart = pairs.where("pivot_root <> other_root").select("pivot", "other").join(best, ["pivot", "other"], "left_anti")
    roots = extended(roots, pivot_links(apart, table, docs, n, threshold))
    more = group_links(members.select("key", "set_id"), roots, table, docs, n, threshold)
    remove_written(members, keys, all_pairs)
    if more is not None:
        roots = extended(roots, more)
    labelled = table.select("doc_id", "row_key", "n_shingles", "set_id").join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
    return labelled.select("doc_id", "row_key", "n_shingles", "set_id", F.coalesce("root", "set_id").alias("root"))


def link_components(docs: DataFrame, n: int = 5, threshold: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id of its component) of each row of ``docs``."""
    named = linked_rows(docs, n, threshold).select("doc_id", "n_shingles", "root")
    # Rows of one component can be a third of all: only its least doc_id is gathered, then joined back.
    least = written(named.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    return named.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, threshold: int = 80) -> DataFrame:
    """One row of each component; columns as they came.

    It is the row of the smallest doc_id (null ones come last), then of the smallest
    set_id. Of repeated rows (same doc_id and text) one stays; blank texts all stay.
    """
    found = linked_rows(docs.select("doc_id", "text"), n, threshold).where("root IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "set_id", "row_key")).alias("first")
    chosen = written(found.groupBy("root").agg(first).select(F.col("first.row_key").alias("_row_key")), "chosen")
    words = F.coalesce(F.col("text").rlike(WORD_PATTERN), F.lit(False))
    copy = F.row_number().over(Window.partitionBy("_row_key").orderBy("_row_key"))
    # One copy is taken in each partition already: there can be very many of one row.
    single = docs.where(words).withColumn("_row_key", row_key()).withColumn("_copy", copy).where("_copy = 1").drop("_copy")
    kept = single.join(chosen, "_row_key", "left_semi")
    return kept.select(*docs.columns).unionByName(docs.where(~words))
