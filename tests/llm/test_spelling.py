"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bedside.llm import queries, spelling
from tests.llm import data


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b))) if len(b) == len(a) + 1 else False


def counts_of(rows, altered=True):
    out = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(data.FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if altered and h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def expected(n):
    near = {w: [o for o in n if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def texts(seed=2):
    """Words with edits of all kinds, chains of forms, long runs, other scripts, and letters beyond ASCII."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcÉé") for _ in range(rng.randrange(6, 12))) for _ in range(40)]
    base += ["aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "xyzzyxyz" * 12, "xyzzyxyz" * 12 + "z", "straße×ab", "Straße÷ab", "İstanbullu"]
    words = []
    for w in base:
        words += [w] * rng.choice([2, 2, 3, 30, 400])
        for _ in range(6):
            at = rng.randrange(len(w))
            edited = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abcÿ") + w[at:], w[:at] + rng.choice("abcÀ") + w[at + 1 :]])
            words += [edited] * rng.choice([1, 2, 3, 40])
    words += ["chainedab"] * 2 + ["chainedabc"] * 25 + ["chainedabcd"] * 300 + ["Chainedabcde"] * 3001
    rng.shuffle(words)
    rows = [(None if i % 50 == 0 else i % 30, " ".join(words[i : i + 40]) + ".7,漢字" + words[i], "clash") for i in range(0, len(words), 40)]
    return [*rows, (3, None, None), (4, "", None), (5, " \n", None), (6, "short words only", None)]


SCHEMA = "doc_id long, text string, word string"


@pytest.mark.parametrize("group, tile", [(1024, 64), (3, 2), (1, 4)])
def test_variants(spark, monkeypatch, group, tile):
    monkeypatch.setattr(spelling, "GROUP_ROWS", group)
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = rows_of(spelling.variants(docs, spelling.planted))
    assert got == expected(counts_of(rows))
    assert any(r[3] for r in got)


def test_roots_follow_forms(spark):
    rows = texts()
    got = rows_of(spelling.variants(spark.createDataFrame(rows, SCHEMA)))
    assert got == expected(counts_of(rows, altered=False))
    assert {r[0]: r[5] for r in got}["chainedab"] == "chainedabcde"


def test_hot_group_is_halved(spark, monkeypatch):
    """Words that differ in one region only: no group that is compared is over the bound."""
    monkeypatch.setattr(spelling, "GROUP_ROWS", 8)
    words = [(f"prefix{a}{b}{c}suffix", 2) for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    rows, _ = spelling.bounded_groups(spelling.region_rows(spark.createDataFrame(words, "word string, n long")))
    assert rows.groupBy("key").count().agg({"count": "max"}).first()[0] <= 8
    near = spelling.near_pairs(rows).collect()
    assert len(near) == len({(r.word, r.other) for r in near}) == 216 * 15


def test_tiles_meet_all_pairs_once():
    rng = random.Random(5)
    words = list({"".join(rng.choice("ab") for _ in range(rng.choice([7, 8]))) for _ in range(300)})
    points, sizes = spelling.matrix(words)
    seen = Counter()
    counts = np.array([1, 2, 3, 70, len(words) - 76])
    for left, right in spelling.tiles_of(np.cumsum(counts) - counts, counts):
        for a, b, _ in zip(*spelling.near_in_tiles((points, spelling.reversed_rows(points, sizes), sizes), left, right)):
            seen[min(a, b), max(a, b)] += a < b
    group = np.repeat(np.arange(5), counts)
    want = [(i, j) for j in range(len(words)) for i in range(j) if group[i] == group[j] and one_edit(words[i], words[j])]
    assert sorted(seen) == sorted(want) and set(seen.values()) == {1}


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(docs).collect() == []


def test_query(spark, tmp_path):
    rows = data.corpus() + [(500 + i, t, None, None, None) for i, (_, t, _) in enumerate(texts(8))]
    spark.createDataFrame(rows, data.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(queries.QUERIES["op13_spelling_variants"](spark, str(tmp_path))) == expected(counts_of(rows))
