"""Packing documents into training sequences by harmonic classes (operator 11).

A piece of ``r`` tokens belongs to class ``k = capacity // r``: its length is over
``capacity / (k + 1)`` and at most ``capacity / k``, so any ``k`` pieces of the class fit one
sequence. Each task fills the sequences of a class with exactly ``k`` pieces, whatever other
tasks do; nothing is shuffled, and a rerun task remakes its own sequences only.

Documents may be cut. One gives off whole sequences first; what is left stays whole where the
padding it brings, ``capacity / k - r``, is small against the document (``slack``), else it is
cut at the reciprocal ``capacity // (k + 1)``. The rest is then shorter than
``capacity / (k * (k + 1))``, so few cuts suffice.

At its end a task has fewer than ``k`` pieces of each class. They are laid one after another
and cut at the capacity; the last, short sequence is cut into lengths that are powers of two,
which need no padding.

Texts are encoded by the public ``tokenizers`` file of byte-level pieces; a task encodes a
pre-token once and looks it up from then on.

Defined cases: null and empty texts are the end id alone; special strings inside texts become
their ids, as in the library; a null doc_id stays null; repeated rows are packed each; an
empty table gives no pieces; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.llm.bpe import PLAIN_BELOW, WordBpe, byte_symbols, spread
from bedside.llm.common import no_cycle_collection, slices

CAPACITY = 2048
#: A rest is cut further only where its padding is over this share of the document.
SLACK = 1 / 256
SLICE_BYTES = 2_000_000
#: Longer texts are encoded part by part.
PART_CHARS = 1_000_000
#: Tokens in one record batch, about.
BATCH_TOKENS = 2_000_000
#: Numbers of sequences: the task's number, then this many bits of its own count.
COUNT_BITS = 40
#: White space as the vocabulary's pattern has it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Marks the cuts of a text; texts that hold it themselves are cut otherwise.
CUT = "\0"
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def default_path() -> str:
    """The 50k byte-level vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def plain_pattern() -> re.Pattern:
    """The byte-level pre-token pattern with letter, number and space classes spelled out below ``PLAIN_BELOW``."""
    kinds: dict[str, list[str]] = {"L": [], "N": []}
    for code in range(PLAIN_BELOW):
        kind = unicodedata.category(chr(code))[0]
        if kind in kinds:
            kinds[kind].append(re.escape(chr(code)))
    letter, number = "".join(kinds["L"]), "".join(kinds["N"])
    other = f"[^{SPACE}{letter}{number}]"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?{other}+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class ByteBpe(WordBpe):
    """Encoder for one byte-level vocabulary file; a task builds one.

    No pre-token reaches from another character into white space, so texts are cut there into
    chunks. Arrow does so before every space and line end, which is wrong only inside longer white space
    (``odd``); texts with such runs are cut by the regular expression ``chunk``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.bytes_of = {c: b for b, c in enumerate(byte_symbols())}
        self.pattern = plain_pattern()
        self.other = re.compile(f"[^\x00-{chr(PLAIN_BELOW - 1)}]")
        self.chunk = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.end_of_chunk = re.compile(f"[^{SPACE}](?=[{SPACE}])")
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.odd = "|".join([CUT, f"[{SPACE}][ \n](?:[{SPACE}]|$)", *map(re.escape, self.special)])
        self.forget()

    def parts(self, text: str) -> list[str]:
        """The text, cut between chunks where it is very long."""
        out, at = [], 0
        while len(text) - at > PART_CHARS:
            cut = self.end_of_chunk.search(text, at + PART_CHARS)
            if cut is None:
                break
            out.append(text[at : cut.end()])
            at = cut.end()
        return [*out, text[at:]]

    def _chunks(self, text: str) -> list[str]:
        return self.chunk.findall(text)

    def split(self, chunk: str) -> list[str]:
        """Pre-tokens of one chunk."""
        if chunk.isascii() or not self.other.search(chunk):
            return self.pattern.findall(chunk)
        # Rare scripts: the library's own Unicode tables decide.
        return [bytes(self.bytes_of[c] for c in w).decode("utf-8") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.library_merge(words)

    def chunked(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All chunks of texts without nulls; first chunk and number of chunks of each text."""
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        marked = pc.replace_substring(pc.replace_substring(texts, " ", CUT + " "), "\n", CUT + "\n")
        cut = pc.split_pattern(marked, CUT)
        offsets = np.asarray(cut.offsets).astype(np.int64)
        chunks = cut.flatten()
        starts, counts = offsets[:-1] - offsets[0], np.diff(offsets)
        if len(odd):
            own = [self.chunks(texts[i].as_py()) for i in odd.tolist()]
            counts[odd] = list(map(len, own))
            starts[odd] = len(chunks) + np.cumsum(counts[odd]) - counts[odd]
            chunks = pa.concat_arrays([chunks, pa.array([c for words in own for c in words], pa.string())])
        return chunks, starts, counts

    def encode_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, very long texts part by part."""
        if not len(texts) or (pc.max(pc.utf8_length(texts)).as_py() or 0) <= PART_CHARS:
            return self.encode(texts)
        made, counts = [], []
        for text in texts.to_pylist():
            parts = [self.encode([p])[0] for p in self.parts(text or "")]
            made += parts
            counts.append(sum(map(len, parts)))
        return np.concatenate(made), np.array(counts, dtype=np.int64)


@lru_cache(maxsize=2)
def coder(path: str) -> ByteBpe:
    """This worker's encoder."""
    return ByteBpe(path)


def cut(tokens: np.ndarray, capacity: int = CAPACITY, slack: float = SLACK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents of these lengths: document, start and length of each, in order of document and start."""
    whole = tokens // capacity
    doc = np.repeat(np.arange(len(tokens)), whole)
    docs, starts = [doc], [spread(np.zeros(len(tokens), np.int64), whole) * capacity]
    lengths = [np.full(len(doc), capacity, dtype=np.int64)]
    left, at = np.flatnonzero(tokens % capacity), (whole * capacity)[tokens % capacity > 0]
    while len(left):
        rest = tokens[left] - at
        k = capacity // rest
        keep = capacity / k - rest <= slack * tokens[left]
        size = np.where(keep, rest, capacity // (k + 1))
        docs.append(left)
        starts.append(at)
        lengths.append(size)
        left, at = left[~keep], (at + size)[~keep]
    doc, start, length = map(np.concatenate, (docs, starts, lengths))
    order = np.lexsort((start, doc))
    return doc[order], start[order], length[order]


class Pile:
    """Pieces with the places of their ids in ``data``, column by column."""

    COLUMNS = ("doc", "start", "length", "total", "at")

    def __init__(self, data: np.ndarray, doc: pa.Array, start, length, total, at):
        self.data, self.doc, self.start, self.length, self.total, self.at = data, doc, start, length, total, at

    @staticmethod
    def empty() -> Pile:
        none = np.zeros(0, np.int64)
        return Pile(np.zeros(0, np.uint32), pa.array([], pa.int64()), none, none, none, none)

    def joined(self, other: Pile) -> Pile:
        columns = [np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("start", "length", "total")]
        at = np.concatenate([self.at, other.at + len(self.data)])
        return Pile(np.concatenate([self.data, other.data]), pa.concat_arrays([self.doc, other.doc]), *columns, at)

    def taken(self, rows: np.ndarray) -> Pile:
        return Pile(self.data, self.doc.take(pa.array(rows)), self.start[rows], self.length[rows], self.total[rows], self.at[rows])

    def compact(self) -> Pile:
        """Without ids that no piece has."""
        data = self.data[spread(self.at, self.length)]
        return Pile(data, self.doc, self.start, self.length, self.total, np.cumsum(self.length) - self.length)

    def recut(self, bounds: np.ndarray) -> Pile:
        """The pieces one after another, cut at these places, which rise."""
        ends = np.cumsum(self.length)
        firsts = ends - self.length
        edges = np.unique(np.concatenate([firsts, bounds[bounds < (ends[-1] if len(ends) else 0)]]))
        owner = np.searchsorted(firsts, edges, side="right") - 1
        out = self.taken(owner)
        into = edges - firsts[owner]
        out.start, out.at = out.start + into, out.at + into
        out.length = np.diff(np.r_[edges, ends[-1:]])
        return out


def fill(pile: Pile, capacity: int) -> tuple[Pile, np.ndarray, Pile]:
    """Full bins of each class: their pieces in order, the number of each piece's bin, and the pieces left over."""
    k = capacity // pile.length
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.searchsorted(k, k, side="left")
    count = np.searchsorted(k, k, side="right") - first
    inside = np.arange(len(k)) - first < count // np.maximum(k, 1) * k
    kept, k = order[inside], k[inside]
    fresh = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    place = np.arange(len(k)) - np.maximum.accumulate(np.where(fresh, np.arange(len(k)), 0))
    bins = np.cumsum(place % np.maximum(k, 1) == 0) - 1
    return pile.taken(kept), bins, pile.taken(order[~inside])


def close(pile: Pile, capacity: int) -> tuple[Pile, np.ndarray]:
    """The last pieces of a task in sequences of the capacity and, for the rest, of powers of two."""
    total = int(pile.length.sum())
    bounds, at = list(range(0, total - total % capacity + 1, capacity)), total - total % capacity
    for bit in reversed(range((total - at).bit_length())):
        if (total - at) >> bit & 1:
            at += 1 << bit
            bounds.append(at)
    edges = np.array(bounds, dtype=np.int64)
    out = pile.recut(edges)
    return out, np.searchsorted(edges, np.cumsum(out.length) - out.length, side="right") - 1


def _batches(pile: Pile, bins: np.ndarray, first_bin: int) -> Iterator[pa.RecordBatch]:
    fresh = np.r_[True, bins[1:] != bins[:-1]] if len(bins) else np.zeros(0, bool)
    before = np.cumsum(pile.length) - pile.length
    offset = before - np.maximum.accumulate(np.where(fresh, before, 0)) if len(bins) else before
    part = before // BATCH_TOKENS
    edges = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist(), len(part)] if len(part) else []
    for a, b in zip(edges, edges[1:]):
        rows = slice(a, b)
        length = pile.length[rows]
        data = pile.data[spread(pile.at[rows], length)].astype("<u4").tobytes()
        places = pa.array(np.r_[0, np.cumsum(length) * 4].astype(np.int32))
        ids = pa.Array.from_buffers(pa.binary(), len(length), [None, places.buffers()[1], pa.py_buffer(data)])
        columns = [
            pile.doc.slice(a, b - a),
            *map(pa.array, (pile.start[rows], length)),
            ids,
            *map(pa.array, (pile.total[rows], bins[rows] + first_bin, offset[rows])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 1, slack: float = SLACK
) -> DataFrame:
    """Pieces of all documents (doc_id, text): doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit integers; ``start`` counts the document's ids before
    the piece, ``offset`` those of its sequence. Each document ends with ``end_id``.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycle_collection():
            words = coder(path)
            number = TaskContext.get().partitionId() << COUNT_BITS
            pending = Pile.empty()
            for batch in slices(batches, "text", SLICE_BYTES):
                ids, counts = words.encode_parts(batch["text"])
                data, tokens = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                doc, start, length = cut(tokens, capacity, slack)
                at = (np.cumsum(tokens) - tokens)[doc] + start
                new = Pile(data, batch["doc_id"].take(pa.array(doc)), start, length, tokens[doc], at)
                done, bins, left = fill(pending.joined(new), capacity)
                yield from _batches(done, bins, number)
                number += int(bins[-1]) + 1 if len(bins) else 0
                pending = left.compact()
            yield from _batches(*close(pending, capacity), number)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, ids (binary, padded), n_tokens, n_pieces, starts (of its pieces).

    A sequence is padded to the capacity unless its length is a power of two. Groups hold one sequence.
    """
    piece = F.struct("offset", "ids")
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.count("*").alias("n_pieces"), F.sort_array(F.collect_list(piece)).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    even = F.bit_count("n_tokens") == 1
    gap = F.when(even, 0).otherwise(capacity - F.col("n_tokens"))
    padding = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), gap.cast("int")))
    starts = F.transform("parts", lambda p: p["offset"])
    return whole.select("sequence_id", F.concat(joined, padding).alias("ids"), "n_tokens", "n_pieces", starts.alias("starts"))
