"""Grouping spelling variants by single edits (operator 13).

Words are laid out as padded code-point matrices. Tiles compare a block of rows with a block of rows,
all at once: the length of the common prefix plus that of the common suffix reaches the longer
length minus one just where one code point is inserted, deleted or replaced.

Not all blocks need to meet. The edit of a pair lies in one of a few regions of the longer word, and both words agree
before and after that region; so words are grouped by what is outside of each region
(``REGIONS`` of them for each length that a word may be compared at), and tiles are those of a group. A pair
is taken in the region that holds the first place where it can be edited, hence once. A group of more than
``GROUP_ROWS`` words is grouped anew by halves of its region, down to single places, where no group is larger than the
alphabet; so no task gets an unbounded group, whatever the words have in common.

A word's form is its near word with the largest count, if that is at least ``RATIO`` times its own. Counts rise by that
factor from form to form, so the largest count bounds the number of steps to a root. Few words share a form, as a word has
few neighbours at one edit, so no step joins on a hot key.

Defined cases: null and empty texts have no words; a null doc_id counts as an empty one where words are altered; an
empty table gives no rows; ties of count go to the least word in code-point order; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.llm.common import no_cycle_collection, remove_written, slices, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
REGIONS = 4
GROUP_ROWS = 1024
#: Rows of a tile's side.
TILE = 64
#: Cells of a stack of tiles, about.
STACK_CELLS = 8_000_000
#: Words that a task counts before it puts out the counts.
HELD_WORDS = 500_000
LETTERS = "A-Za-zÀ-ÿ"
_fold = {c: c + 32 for c in range(65, 91)}

#: From a document's identifier and a folded run of letters to the word that is counted.
Alter = Callable[[str, str], str]


def planted(doc_id: str, run: str) -> str:
    """The run without one code point where the checksum of ``doc_id:run`` is a multiple of 31."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, alter: Alter | None = None) -> DataFrame:
    """word and n of all words of ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences at least.

    Tasks count their own words first, so a frequent word is a row per task in the exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}").findall
        folded: dict[str, str] = {}
        held: Counter[str] = Counter()

        def put() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            folded.clear()
            return out

        with no_cycle_collection():
            for part in slices(batches, "text"):
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                    for found, n in Counter(find(text)).items():
                        word = folded.get(found)
                        if word is None:
                            word = folded[found] = found.translate(_fold)
                        held[word if alter is None else alter(doc_id, word)] += n
                    if len(held) > HELD_WORDS:
                        yield put()
            yield put()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").where("text IS NOT NULL")
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def regions(length: int, number: int = REGIONS) -> list[tuple[int, int]]:
    """Ranges of places that cover a word of this length."""
    number = min(number, length)
    edges = [i * length // number for i in range(number + 1)]
    return list(zip(edges, edges[1:]))


def outside(word: str, length: int, low: int, high: int) -> int:
    """A number for what a word has before and after the places low..high of words of ``length``, 64 bits."""
    before, after = word[:low].encode(), word[len(word) - (length - high) :].encode()
    digest = xxhash.xxh3_64(f"{length} {low} {high} {len(before)} ".encode())
    digest.update(before)
    digest.update(after)
    return digest.intdigest() - (1 << 63)


def region_rows(words: DataFrame) -> DataFrame:
    """Per word, length (its own and the next) and region: key, word, n, length, low, high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 500_000):
            out = []
            for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist()):
                for length in (len(word), len(word) + 1):
                    for low, high in regions(length):
                        out.append((outside(word, length, low, high), word, n, length, low, high))
            yield _region_batch(out)

    return words.mapInArrow(run, REGION_SCHEMA)


REGION_SCHEMA = "key long, word string, n long, length int, low int, high int"


def _region_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    columns = zip(*rows) if rows else [()] * 6
    names = [c.split()[0] for c in REGION_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def halved(rows: DataFrame) -> DataFrame:
    """The same rows grouped by each half of their region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 500_000):
            out = []
            for word, n, length, low, high in zip(*(batch[c].to_pylist() for c in ("word", "n", "length", "low", "high"))):
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle, high)):
                    out.append((outside(word, length, a, b), word, n, length, a, b))
            yield _region_batch(out)

    return rows.mapInArrow(run, REGION_SCHEMA)


def bounded_groups(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Rows by regions small enough that no group has over ``GROUP_ROWS`` words, single places aside; and the tables they are read from."""
    done, tables = None, []
    while True:
        rows = written(rows, "spelling-regions")
        tables.append(rows)
        large = written(rows.where("high - low > 1").groupBy("key").count().where(F.col("count") > GROUP_ROWS).select("key"), "spelling-large")
        tables.append(large)
        if large.isEmpty():
            return (rows if done is None else done.unionByName(rows)), tables
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = halved(rows.join(large, "key", "left_semi"))


def matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with zeros to the longest and one more, and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    out = np.zeros((len(words), int(sizes.max(initial=0)) + 1), dtype=np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = points
    return out, sizes


def reversed_rows(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The words backwards, padded at the end as well."""
    at = sizes[:, None] - 1 - np.arange(points.shape[1])
    return np.where(at >= 0, np.take_along_axis(points, np.maximum(at, 0), axis=1), 0)


def common_prefix(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of a block with each of another: a is (.., m, w), b is (.., n, w)."""
    differ = a[..., :, None, :] != b[..., None, :, :]
    first = differ.argmax(axis=-1)
    return np.minimum(np.where(differ.any(axis=-1), first, a.shape[-1]), limit)


def near_in_tiles(
    words: tuple[np.ndarray, np.ndarray, np.ndarray], left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows one edit apart in stacked tiles, each a block of rows against another (-1: no row).

    Returns the two rows and the first place of the longer word where the edit can be.
    """
    points, backwards, sizes = words
    a, b = np.maximum(left, 0), np.maximum(right, 0)
    short = np.minimum(sizes[a][:, :, None], sizes[b][:, None, :])
    long = np.maximum(sizes[a][:, :, None], sizes[b][:, None, :])
    prefix = common_prefix(points[a], points[b], short)
    suffix = common_prefix(backwards[a], backwards[b], short)
    real = (left >= 0)[:, :, None] & (right >= 0)[:, None, :]
    tile, i, j = np.nonzero(real & (prefix + suffix >= long - 1) & (long - short <= 1) & (prefix < long))
    return left[tile, i], right[tile, j], prefix[tile, i, j]


def tiles_of(starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stacked tiles that cover the pairs of each group: groups of similar size together, large ones as pairs of blocks."""
    side = 2
    while side <= TILE:
        mine = np.flatnonzero((counts > side // 2) & (counts <= side) & (counts > 1))
        rows = np.arange(side)
        block = np.where(rows < counts[mine][:, None], starts[mine][:, None] + rows, -1)
        yield block, block
        side *= 2
    for at in np.flatnonzero(counts > TILE).tolist():
        rows = np.arange(-(-int(counts[at]) // TILE) * TILE)
        blocks = np.where(rows < counts[at], starts[at] + rows, -1).reshape(-1, TILE)
        first, second = np.triu_indices(len(blocks))
        yield blocks[first], blocks[second]


def near_pairs(rows: DataFrame) -> DataFrame:
    """Near words, each pair both ways: word, other, other_n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.RecordBatch | None = None
        for batch in batches:
            batch = batch if carried is None else pa.concat_batches([carried, batch])
            # The last group may go on in the next batch.
            keys = batch["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield from pairs(batch.slice(0, cut))
            carried = batch.slice(cut)
        if carried is not None and carried.num_rows:
            yield from pairs(carried)

    def pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        length = batch["length"].to_numpy()
        key = batch["key"].to_numpy()
        low, high = batch["low"].to_numpy(), batch["high"].to_numpy()
        fresh = np.r_[True, np.any([c[1:] != c[:-1] for c in (key, length, low, high)], axis=0)]
        starts = np.flatnonzero(fresh)
        counts = np.diff(np.r_[starts, len(key)])
        inside = np.repeat(counts > 1, counts)
        if not inside.any():
            return
        batch = batch.filter(pa.array(inside))
        length, low, high = length[inside], low[inside], high[inside]
        counts = counts[counts > 1]
        starts = np.cumsum(counts) - counts
        texts, n = batch["word"].to_pylist(), batch["n"]
        # Long words apart, so that they don't widen the matrix of all.
        for wide in np.unique(width := np.maximum(5, np.ceil(np.log2(length[starts] + 1)).astype(int))).tolist():
            mine = np.flatnonzero(width == wide)
            rows = np.concatenate([np.arange(a, a + c) for a, c in zip(starts[mine], counts[mine])])
            points, sizes = matrix([texts[r] for r in rows.tolist()])
            words = points, reversed_rows(points, sizes), sizes
            own = np.cumsum(counts[mine]) - counts[mine]
            for left, right in tiles_of(own, counts[mine]):
                step = max(1, STACK_CELLS // (left.shape[-1] ** 2 * points.shape[1]))
                for at in range(0, len(left), step):
                    a, b, place = near_in_tiles(words, left[at : at + step], right[at : at + step])
                    a, b, a_size, b_size = rows[a], rows[b], sizes[a], sizes[b]
                    # In its own region, at the length of the longer word, and once where a block meets itself.
                    keep = (low[a] <= place) & (place < high[a]) & (np.maximum(a_size, b_size) == length[a]) & (a < b)
                    a, b = a[keep], b[keep]
                    both, other = pa.array(np.r_[a, b]), pa.array(np.r_[b, a])
                    yield pa.RecordBatch.from_arrays([batch["word"].take(both), batch["word"].take(other), n.take(other)], names=["word", "other", "other_n"])

    grouped = rows.repartition("key").sortWithinPartitions("key", "length", "low", "high")
    return grouped.mapInArrow(run, "word string, other string, other_n long")


def with_roots(formed: DataFrame) -> DataFrame:
    """``formed`` (word, n, form, ..) with ``root``, the last of the forms from the word on; one join per step that counts allow."""
    most = formed.agg(F.max("n")).first()[0] or 0
    links = formed.where("form IS NOT NULL").select("word", "form")
    roots, reached = links.select("word", F.col("form").alias("root")), LEAST_COUNT * RATIO**2
    while reached <= most:
        # Joined on a word's own form, which few words share.
        further = roots.select(F.col("word").alias("form"), "root")
        roots = links.join(further, "form", "left").select("word", F.coalesce("root", "form").alias("root"))
        reached *= RATIO
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, alter: Alter | None = None) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = written(word_counts(docs, alter), "spelling-words")
    rows, tables = bounded_groups(region_rows(words))
    near = near_pairs(rows)
    none = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    both = none.unionByName(near, allowMissingColumns=True)
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))))
    per = both.groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.n") >= RATIO * F.col("n")
    formed = written(
        per.select("word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")),
        "spelling-forms",
    )
    remove_written(words, *tables)
    return with_roots(formed)
