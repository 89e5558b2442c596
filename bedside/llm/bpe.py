"""Byte-pair encoding and decoding of whole texts (operator 5).

The vocabulary is a public ``tokenizers`` file whose pieces end words with
``</w>``. A task splits its texts into pre-tokens, keeps those that it hasn't met,
lays the symbols of all of them in one flat array and merges them in rounds: in
each round every word merges its pair of lowest rank, found by binary search over
the sorted pair keys. Words that have no pair left leave the array.

Defined cases: null and empty texts have no ids and decode to an empty text;
control strings of the vocabulary inside texts become their special ids, as in the
library; repeated rows stay repeated; other columns are kept under their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from bedside.llm.common import map_text

#: A rank above all ranks: no such pair.
NO_PAIR = np.iinfo(np.int64).max
#: Entries of a task's table of encoded chunks; beyond it the table starts anew.
CACHE_ENTRIES = 600_000
#: Symbols that one flat array holds at most, if a single word isn't longer.
FLAT_SYMBOLS = 1_000_000
#: Bytes of text that are encoded at a time, about.
SLICE_BYTES = 2_000_000
#: Below this code point, lower case included, the classes of Python and of the library agree and nothing composes.
PLAIN_BELOW = 0x180


def default_path() -> str:
    """The 49k word vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the others take the code
    points from 256 on, in the order of their bytes.
    """
    out, spare = [], 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def plain_pattern() -> re.Pattern:
    """The pre-token pattern with letter, number and space classes spelled out below ``PLAIN_BELOW``."""
    kinds: dict[str, list[str]] = {"L": [], "N": [], "space": []}
    for code in range(PLAIN_BELOW):
        ch = chr(code)
        kind = "space" if ch.isspace() and not 0x1C <= code <= 0x1F else unicodedata.category(ch)[0]
        if kind in kinds:
            kinds[kind].append(re.escape(ch))
    letters, numbers, spaces = ("".join(kinds[k]) for k in ("L", "N", "space"))
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class Numbers(dict):
    """Numbers of keys; keys that it lacks are noted and read as -1."""

    def __init__(self):
        super().__init__()
        self.missing: dict[str, None] = {}

    def __missing__(self, key: str) -> int:
        self.missing[key] = None
        return -1


class Pieces:
    """Piece lists in one growing flat array, by their number."""

    def __init__(self):
        self.flat = np.zeros(0, dtype=np.uint32)
        self.counts = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)

    def append(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(counts) - counts]
        self.counts = np.r_[self.counts, counts]
        self.flat = np.concatenate([self.flat, flat])

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these numbers one after another, and the length of each."""
        counts = self.counts[numbers]
        return self.flat[spread(self.starts[numbers], counts)], counts


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each run, one run after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


class WordBpe:
    """Encoder and decoder for one vocabulary file; a task builds one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.width = len(vocab)
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        chars = byte_symbols()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + "</w>"] for c in chars], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for piece, i in [*vocab.items(), *self.special.items()]:
            self.pieces[i] = piece
        self.piece_array = pa.array(self.pieces, pa.string())
        self.library = Tokenizer.from_file(path)
        self.bytes_of = {c: b for b, c in enumerate(chars)}
        self.pattern = plain_pattern()
        self.separators = re.compile("[\x1c-\x1f]")
        self.other = re.compile(f"[^\x00-{chr(PLAIN_BELOW - 1)}]")
        marks = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = re.compile(f"({marks})") if marks else None
        #: Texts with these aren't cut at white space alone.
        self.odd = "|".join(["[\x1c-\x1f]", *map(re.escape, self.special)])
        self.forget()

    def forget(self) -> None:
        """Begin the tables of known words and chunks anew."""
        self.words, self.word_pieces = Numbers(), Pieces()
        self.cache, self.chunk_pieces = Numbers(), Pieces()
        self.cache.update(zip(self.special, range(len(self.special))))
        ids = np.array(list(self.special.values()), dtype=np.uint32)
        self.chunk_pieces.append(ids, np.ones(len(ids), dtype=np.int64))

    def chunks(self, text: str) -> list[str]:
        """The text cut at white space, where no pre-token reaches across; special strings stand alone."""
        if self.marks and "<" in text and self.marks.search(text):
            return [w for part in self.marks.split(text) for w in ([part] if part in self.special else self._chunks(part))]
        return self._chunks(text)

    def _chunks(self, text: str) -> list[str]:
        # str.split() also cuts at the four separators that the vocabulary's pattern counts as symbols.
        return [text] if self.separators.search(text) else text.split()

    def split(self, chunk: str) -> list[str]:
        """Normalised pre-tokens of one chunk."""
        if chunk.isascii() or not self.other.search(chunk):
            low = chunk.lower()
            return [low] if low.isalpha() else self.pattern.findall(low)
        # Rare scripts: the library's own Unicode tables decide.
        said = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [bytes(self.bytes_of[c] for c in w).decode("utf-8") for w, _ in said]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], NO_PAIR)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array and how many each word has, by batched merge rounds."""
        blobs = [w.encode("utf-8") for w in words]
        done, at = [], 0
        while at < len(blobs):
            to, held = at, 0
            while to < len(blobs) and (to == at or held + len(blobs[to]) <= FLAT_SYMBOLS):
                held += len(blobs[to])
                to += 1
            done.append(self._merge_flat(blobs[at:to]))
            at = to
        return np.concatenate([flat for flat, _ in done]), np.concatenate([counts for _, counts in done])

    def _merge_flat(self, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(b) for b in blobs], dtype=np.int64)
        flat = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.final[flat[ends]]
        word = np.repeat(np.arange(len(blobs)), sizes)
        rank = np.full(len(sym), NO_PAIR, dtype=np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self._rank(sym[inside], sym[inside + 1])
        done_word, done_sym = [], []
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            count = np.diff(np.r_[first, len(sym)])
            live = np.repeat(least != NO_PAIR, count)
            if not live.all():
                done_word.append(word[~live])
                done_sym.append(sym[~live])
                sym, word, rank = sym[live], word[live], rank[live]
                if not len(sym):
                    break
                least, count = least[least != NO_PAIR], count[least != NO_PAIR]
            hit = rank == np.repeat(least, count)
            if (hit[1:] & hit[:-1]).any():  # the same symbol thrice or more: pairs are taken from the left
                index = np.arange(len(hit))
                start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], index, 0))
                hit &= (index - start) % 2 == 0
            at = np.flatnonzero(hit)
            sym[at] = self.merged[rank[at]]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, word, rank = sym[keep], word[keep], rank[keep]
            at -= np.arange(len(at))
            for near in (at, at[at > 0] - 1):
                ok = near + 1 < len(sym)
                rank[near[~ok]] = NO_PAIR
                near = near[ok]
                same = word[near] == word[near + 1]
                rank[near[~same]] = NO_PAIR
                near = near[same]
                rank[near] = self._rank(sym[near], sym[near + 1])
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.uint32), np.bincount(word, minlength=len(blobs)).astype(np.int64)

    def library_merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge``, by the library's own model."""
        tokens, chars = self.library.model.tokenize, {b: c for c, b in self.bytes_of.items()}
        ids: list[int] = []
        counts = []
        for w in words:
            made = tokens(w.encode("utf-8").decode("latin-1").translate(chars))
            ids += [t.id for t in made]
            counts.append(len(made))
        return np.array(ids, dtype=np.uint32), np.array(counts, dtype=np.int64)

    def learn(self, chunks: list[str], merge: Callable | None = None) -> None:
        """Complete the table for these chunks, new ones all: each new pre-token is merged once."""
        split = [self.split(c) for c in chunks]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        flat = [w for words in split for w in words]
        numbers = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        if self.words.missing:
            new, self.words.missing = list(self.words.missing), {}
            self.words.update(zip(new, range(len(self.words), len(self.words) + len(new))))
            self.word_pieces.append(*(merge or self.merge)(new))
            lacks = np.flatnonzero(numbers < 0)
            numbers[lacks] = [self.words[flat[i]] for i in lacks]
        ids, counts = self.word_pieces.gather(numbers)
        ends = np.r_[0, np.cumsum(counts)][np.cumsum(sizes)]
        self.cache.update(zip(chunks, range(len(self.cache), len(self.cache) + len(chunks))))
        self.chunk_pieces.append(ids, np.diff(np.r_[0, ends]))

    def chunked(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All chunks of texts without nulls; first chunk and number of chunks of each text."""
        cut = pc.utf8_split_whitespace(texts)
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        offsets = np.asarray(cut.offsets).astype(np.int64)
        chunks = cut.flatten()
        starts, counts = offsets[:-1] - offsets[0], np.diff(offsets)
        if len(odd):
            own = [self.chunks(texts[i].as_py()) for i in odd.tolist()]
            counts[odd] = list(map(len, own))
            starts[odd] = len(chunks) + np.cumsum(counts[odd]) - counts[odd]
            chunks = pa.concat_arrays([chunks, pa.array([c for words in own for c in words], pa.string())])
        return chunks, starts, counts

    def encode(self, texts: pa.Array | list[str], merge: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one flat array, and how many each text has; nulls count as empty."""
        texts = pc.fill_null(pa.array(texts, pa.string()), "") if isinstance(texts, list) else pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.cache) > CACHE_ENTRIES:
            self.forget()
        chunks, starts, sizes = self.chunked(texts)
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.cache.__getitem__, distinct), np.int64, len(distinct))
        if self.cache.missing:
            new, self.cache.missing = list(self.cache.missing), {}
            lacks = np.flatnonzero(numbers < 0)
            first = len(self.cache)
            self.learn(new, merge)
            numbers[lacks] = np.arange(first, first + len(new))
        codes = np.asarray(coded.indices)[spread(starts, sizes)]
        ids, counts = self.chunk_pieces.gather(numbers[codes])
        ends = np.r_[0, np.cumsum(counts)][np.cumsum(sizes)]
        return ids, np.diff(np.r_[0, ends])

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The pieces of each list joined by spaces: the vocabulary names no decoder of its own."""
        ids = pa.concat_arrays([ids])  # offsets from 0, no nulls beneath
        pieces = self.piece_array.take(ids.flatten())
        counts = pc.fill_null(pc.list_value_length(ids), 0)
        offsets = pa.array(np.r_[0, np.cumsum(counts.to_numpy(zero_copy_only=False))].astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, pieces), " ")


@lru_cache(maxsize=2)
def coder(path: str) -> WordBpe:
    """This worker's encoder."""
    return WordBpe(path)


def vocabulary_size(path: str) -> int:
    """One more than the greatest id, special ones included."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1


def _ids_array(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def encode(df: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``ids array<int>`` for each row's whole text."""
    path = path or default_path()
    keep = [c for c in (keep if keep is not None else df.columns) if c != ids]

    def make():
        words = coder(path)
        return lambda texts: {ids: _ids_array(*words.encode(texts))}

    return map_text(df, keep, text, make, f"{ids} array<int>", SLICE_BYTES, as_array=True, after=lambda: coder(path).forget())


def decode(df: DataFrame, path: str | None = None, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns plus the decoded text of ``ids``; null ids decode to an empty text."""
    path = path or default_path()
    kinds = dict(df.dtypes)
    keep = [c for c in df.columns if c != decoded]

    def run(batches):
        words = coder(path)
        for batch in batches:
            texts = words.decode(batch.column(batch.schema.get_field_index(ids)))
            kept = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*kept, texts], names=[*keep, decoded])

    return df.select(*keep).mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), f"{decoded} string"]))


def round_trip(df: DataFrame, path: str | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` plus ``ids array<int>`` and the text ``decoded`` from them, in one pass over the texts."""
    path = path or default_path()
    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("ids", "decoded")]

    def make():
        words = coder(path)

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            ids = _ids_array(*words.encode(texts))
            return {"ids": ids, "decoded": words.decode(ids)}

        return work

    return map_text(df, keep, text, make, "ids array<int>, decoded string", SLICE_BYTES, as_array=True)
