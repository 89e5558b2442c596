"""Token ids in sorted-string-table shards (operator 8).

A shard holds documents in ascending order of their identifier, in blocks:

    block   number of entries, then per entry the bytes its key shares with the key
            before and the bytes that follow, then numbers of ids, keys, ids
    index   per block: first key, place, length, checksum
    filter  Bloom filter over the keys
    footer  places of index and filter, numbers of documents and ids, id width, magic

Keys are the identifier in 8 bytes whose order is that of the numbers; a null
identifier has the empty key and comes first. A reader looks a document up by the
filter, a binary search over the index and one over a block.

Quantiles of the identifiers range the documents, so shard n's keys all come before
those of shard n + 1; an identifier of very many rows is dealt to several shards. Texts
are encoded where they are read, and ids travel to the shards. A task writes its shard
under a name of its own attempt and renames it, so a lost executor's work is just done
again. Shards and manifest are in the folder that the cluster shares.

Defined cases: null and empty texts have the end id only; repeated identifiers stay,
those with equal texts in any order; an empty table gives no shards.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bedside.llm.bpe import SLICE_BYTES, coder, default_path, vocabulary_size
from bedside.llm.common import checkpoint_dir, no_cycle_collection, slices, written

MAGIC = b"BSIDESST"
FOOTER = struct.Struct("<QQQQQII8s")
BLOCK = struct.Struct("<I")
PLACE = struct.Struct("<HQII")
BLOCK_IDS, BLOCK_DOCS = 65_536, 256
BLOOM_BITS, BLOOM_HASHES = 10, 7
#: Stands for a null identifier where documents are ranged.
LEAST_ID = -(1 << 63)


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", doc_id + (1 << 63))


def doc_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def shared_bytes(a: bytes, b: bytes) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _bits(key: bytes, m: int) -> list[int]:
    h = xxhash.xxh128_intdigest(key)
    a, b = h & (2**64 - 1), (h >> 64) | 1
    return [(a + i * b) % m for i in range(BLOOM_HASHES)]


class Writer:
    """Writes entries that come in key order to a binary stream."""

    def __init__(self, out, width: int = 4):
        self.out, self.width, self.at = out, width, 0
        self.keys: list[bytes] = []
        self.counts: list[int] = []
        self.data: list[bytes] = []
        self.held = 0
        self.index: list[bytes] = []
        self.marks: list[list[bytes]] = []
        self.docs = self.ids = 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        self.add_bytes(key, ids.astype(f"<u{self.width}").tobytes())

    def add_bytes(self, key: bytes, data: bytes) -> None:
        """``data``: ids as little-endian integers of this file's width."""
        self.keys.append(key)
        self.counts.append(len(data) // self.width)
        self.data.append(data)
        self.held += len(data) // self.width
        if self.held >= BLOCK_IDS or len(self.keys) >= BLOCK_DOCS:
            self._flush()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _flush(self) -> None:
        if not self.keys:
            return
        shared = [0, *map(shared_bytes, self.keys, self.keys[1:])]
        rest = [k[s:] for k, s in zip(self.keys, shared)]
        n = len(self.keys)
        block = b"".join([BLOCK.pack(n), bytes(shared), bytes(map(len, rest)), np.array(self.counts, "<u4").tobytes(), *rest, *self.data])
        self.index.append(PLACE.pack(len(self.keys[0]), self.at, len(block), zlib.crc32(block)) + self.keys[0])
        self._put(block)
        self.marks.append(self.keys)
        self.docs, self.ids = self.docs + n, self.ids + self.held
        self.keys, self.counts, self.data, self.held = [], [], [], 0

    def close(self) -> None:
        self._flush()
        index_at = self.at
        self._put(b"".join(self.index))
        bloom_at = self.at
        m = max(64, self.docs * BLOOM_BITS)
        bits = np.zeros(m, dtype=bool)
        for keys in self.marks:
            for k in keys:
                bits[_bits(k, m)] = True
        self._put(np.packbits(bits, bitorder="little").tobytes())
        self._put(FOOTER.pack(index_at, bloom_at, m, self.docs, self.ids, self.width, len(self.index), MAGIC))


class Reader:
    """Reads one shard from a random-access file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        foot = self._at(size - FOOTER.size, FOOTER.size)
        index_at, bloom_at, self.m, self.docs, self.ids, self.width, blocks, magic = FOOTER.unpack(foot)
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        raw = self._at(index_at, bloom_at - index_at)
        self.bloom = np.frombuffer(self._at(bloom_at, size - FOOTER.size - bloom_at), dtype=np.uint8)
        self.index, at = [], 0
        for _ in range(blocks):
            n, place, length, crc = PLACE.unpack_from(raw, at)
            at += PLACE.size
            self.index.append((raw[at : at + n], place, length, crc))
            at += n

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def block(self, number: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Keys, numbers of ids, and the ids of all its documents in one array."""
        _, place, length, crc = self.index[number]
        data = self._at(place, length)
        if zlib.crc32(data) != crc:
            raise ValueError(f"block {number} is damaged")
        (n,) = BLOCK.unpack_from(data)
        shared, rest = data[4 : 4 + n], data[4 + n : 4 + 2 * n]
        counts = np.frombuffer(data, "<u4", n, 4 + 2 * n)
        at, key, keys = 4 + 6 * n, b"", []
        for s, r in zip(shared, rest):
            key = key[:s] + data[at : at + r]
            keys.append(key)
            at += r
        return keys, counts.astype(np.int64), np.frombuffer(data, f"<u{self.width}", int(counts.sum()), at)

    def scan(self) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        for number in range(len(self.index)):
            yield self.block(number)

    def get(self, key: bytes) -> np.ndarray | None:
        """Ids of the first document with this key, or None."""
        if not all(self.bloom[b >> 3] >> (b & 7) & 1 for b in _bits(key, self.m)):
            return None
        firsts = [i[0] for i in self.index]
        number = max(bisect_right(firsts, key) - 1, 0)
        while number > 0 and firsts[number] == key:
            number -= 1  # repeated keys may begin in a block before
        for n in range(number, len(self.index)):
            keys, counts, ids = self.block(n)
            at = bisect_left(keys, key)
            if at < len(keys) and keys[at] == key:
                begin = int(counts[:at].sum())
                return ids[begin : begin + int(counts[at])]
            if keys[-1] > key:
                return None
        return None


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark prints it: file:/x, file:///x, or another scheme."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme; one without is on Spark's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _rank(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LEAST_ID))


def range_bounds(docs: DataFrame, shards: int) -> list[int]:
    """Greatest identifier of each shard but the last, from the identifiers alone; a null counts as the least."""
    if shards < 2:
        return []
    at = [i / shards for i in range(1, shards)]
    return docs.agg(F.percentile_approx(_rank(F.col("doc_id")), at, max(10_000, 20 * shards))).first()[0] or []


def shard_of(ranks: np.ndarray, nulls: np.ndarray, ties: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The shard of each row; rows of an identifier that fills several shards are dealt by their tie, in its order."""
    low, high = np.searchsorted(bounds, ranks, "left"), np.searchsorted(bounds, ranks, "right")
    share = ((ties >> 12) + (1 << 51)) / (1 << 52)
    least = ranks == LEAST_ID  # a null comes before the least identifier
    share = np.where(least, np.where(nulls, share / 2, 0.5 + share / 2), share)
    dealt = np.minimum((share * (high - low)).astype(np.int64), high - low - 1)
    return low + np.where(high - low > 1, dealt, 0)


def encoded(docs: DataFrame, bounds: list[int], end_id: int, width: int, path: str) -> DataFrame:
    """doc_id, tie, shard and ids (little-endian, ``width`` bytes each, end id included) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(bounds, dtype=np.int64)
        with no_cycle_collection():
            words = coder(path)
            for part in slices(batches, "text", SLICE_BYTES):
                ids, counts = words.encode(part["text"], words.library_merge)
                ends = np.cumsum(counts)
                data = np.insert(ids, ends, end_id).astype(f"<u{width}").tobytes()
                offsets = np.r_[0, (ends + np.arange(1, len(ends) + 1)) * width].astype(np.int32)
                made = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                nulls = part["doc_id"].is_null().to_numpy(zero_copy_only=False)
                shard = shard_of(part["rank"].to_numpy(), nulls, part["tie"].to_numpy(), edges)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["tie"], pa.array(shard.astype(np.int32)), made], names=["doc_id", "tie", "shard", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), _rank(F.col("doc_id")).alias("rank"), F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(run, "doc_id long, tie long, shard int, ids binary")


def write_shards(docs: DataFrame, folder: str, end_id: int = 1, path: str | None = None, shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text), write shards to ``folder`` and return their manifest: shard, path, docs, ids, start.

    Without ``shards`` there are as many as the table's own partitions.
    """
    path = path or default_path()
    width = 2 if max(end_id + 1, vocabulary_size(path)) <= 65_536 else 4
    folder = qualified(docs.sparkSession, folder)
    shards = shards or max(1, docs.rdd.getNumPartitions())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycle_collection():
            yield from shard_file(batches)

    def shard_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = _filesystem(folder)
        shard = TaskContext.get().partitionId()
        name = f"{at}/shard-{shard:07d}.sst"
        draft, out, writer = f"{name}.{uuid.uuid4().hex}", None, None
        for part in slices(batches, "ids"):
            if writer is None:
                fs.create_dir(at, recursive=True)
                out = fs.open_output_stream(draft)
                writer = Writer(out, width)
            for doc, data in zip(part["doc_id"].to_pylist(), part["ids"].to_pylist()):
                writer.add_bytes(key_of(doc), data)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(draft, name)
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/shard-{shard:07d}.sst"], "docs": [writer.docs], "ids": [writer.ids]})

    rows = encoded(docs, range_bounds(docs, shards), end_id, width, path)
    ranged = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    manifest = written(ranged.mapInArrow(write, "shard long, path string, docs long, ids long"), "shards")
    # One row per shard: the sum over all of them is short work.
    order = Window.orderBy("shard")
    return manifest.withColumn("start", F.sum("ids").over(order) - F.col("ids"))


def read_shards(manifest: DataFrame) -> DataFrame:
    """Read shards back: doc_id, start (ids of all documents before), n_tokens, ids (little-endian, 4 bytes each)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
                fs, place = _filesystem(at)
                with fs.open_input_file(place) as file:
                    for keys, counts, ids in Reader(file).scan():
                        ends = np.cumsum(counts)
                        offsets = np.r_[0, ends * 4].astype(np.int32)
                        data = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4").tobytes())])
                        yield pa.RecordBatch.from_arrays([pa.array(map(doc_of, keys), pa.int64()), pa.array(start + ends - counts), pa.array(counts), data], names=["doc_id", "start", "n_tokens", "ids"])
                        start += int(ends[-1])

    shards = manifest.count()
    placed = manifest.repartition(max(1, shards), "shard") if shards > 1 else manifest
    return placed.select("path", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def shard_folder(spark) -> str:
    """A new folder in the place that the cluster shares."""
    return f"{checkpoint_dir(spark)}/sst-{uuid.uuid4().hex}"
