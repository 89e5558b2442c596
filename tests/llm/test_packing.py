"""Packing: every id once, little padding, harmonic bins, the library's ids."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from bedside.llm import packing, queries
from tests.llm import data


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.default_path())


def same_ids(texts, library):
    words = packing.ByteBpe(packing.default_path())
    ids, counts = words.encode_parts(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(ends - counts, ends)] == want


def test_ids_are_the_library_s(library, monkeypatch):
    rng = random.Random(4)
    signs = "ab'sÉ \n\t\x85\xa0 　\x1cЖ漢İ1!\0"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    bits = ["a", " ", "\n", "b'll", "<|endoftext|>", "Word"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(3000)]
    same_ids([*texts, None, ""], library)
    monkeypatch.setattr(packing, "PART_CHARS", 10)
    same_ids(texts, library)
    same_ids([t for _, t, *_ in data.corpus()], library)


def checked(pieces, want, capacity):
    """Whole documents from the pieces, and the share of padding."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0
        by_doc.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == want.keys()
    for doc, parts in by_doc.items():
        parts.sort(key=lambda p: p[0])
        assert np.concatenate([p[1] for p in parts]).tolist() == want[doc]
        assert [p[0] for p in parts] == [0, *np.cumsum([len(p[1]) for p in parts])[:-1].tolist()]
        assert {p[2] for p in parts} == {len(want[doc])}
    padded = 0
    for parts in by_sequence.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts]).tolist()
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= capacity
        padded += ends[-1] if ends[-1].bit_count() == 1 else capacity
    return 1 - sum(map(len, want.values())) / padded


def test_pack(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_BYTES", 3000)
    rows = [(i, t, "extra") for i, (_, t, *_) in enumerate(data.corpus())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(2)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _ in rows}
    for capacity in (2048, 100):
        pieces = packing.pack(docs, capacity=capacity)
        assert checked(pieces.collect(), want, capacity) < 0.02
    whole = packing.sequences(packing.pack(docs)).collect()
    assert all(len(r.ids) == 4 * (2048 if r.n_tokens.bit_count() > 1 else r.n_tokens) for r in whole)
    assert sum(r.n_tokens for r in whole) == sum(map(len, want.values()))


def test_pack_nulls_and_repeats(spark):
    rows = [(None, None), (None, "a b"), (5, "same"), (5, "same"), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = packing.pack(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.doc_tokens) for r in got if r.start == 0) == [
        (False, 5, 2), (False, 5, 2), (False, 6, 1), (True, 0, 1), (True, 0, 3)
    ]
    assert packing.pack(docs.where("false")).count() == 0


def test_cuts_are_harmonic():
    tokens = np.arange(1, 10_000)
    doc, start, length = packing.cut(tokens, 2048, 0.0)
    assert np.bincount(doc, length).astype(int).tolist() == tokens.tolist()
    share = 2048 / (2048 // length) - length
    assert (share < 2048 // length + 1).all()  # a piece lacks at most the rounding of its class
    assert np.bincount(doc).max() <= 4 + 5  # four whole sequences and few cuts
    pile = packing.Pile(np.zeros(1, np.uint32), pa.array(doc), start, length, tokens[doc], np.zeros(len(doc), np.int64))
    full, bins, left = packing.fill(pile, 2048)
    classes = 2048 // full.length
    held = np.bincount(bins)
    assert (held[bins] == classes).all() and np.bincount(bins, full.length).max() <= 2048
    assert len(full.length) + len(left.length) == len(length)
    assert all((2048 // left.length == k).sum() < k for k in set((2048 // left.length).tolist()))


def test_query(spark, library, tmp_path):
    rows = data.corpus()
    spark.createDataFrame(rows, data.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_packing"](spark, str(tmp_path)).collect()
    text = {d: t for d, t, *_ in rows}
    for r in got:
        ids = [*library.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 1]
        piece = np.array(ids[r.start : r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and len(piece) == r.length and r.doc_tokens == len(ids)
