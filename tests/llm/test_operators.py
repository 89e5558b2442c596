"""Each operator against plain Python, the library or an exact round trip, on awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside.llm import bpe, chat, classifier, jaccard_join, mixing, quality_rules, sstable, suffix_dedup, textstats, token_counts, topk
from bedside.llm.components import components as spark_components
from tests.llm import data


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    return data.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, data.COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], data.COLUMNS)


@pytest.fixture(scope="module")
def library():
    return bpe.WordBpe(bpe.default_path()).library


# 1 suffix-array dedup


def dedup_rows(df, length=200):
    out = suffix_dedup.remove_repeats(df, length)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in out.collect()), key=str)


def dedup_expected(rows, length=200):
    out = []
    for (d, t, *_), cover in zip(rows, data.removed([r[1] for r in rows], length)):
        b = (t or "").encode()
        runs = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out.append((d, len(b), sum(cover), runs, sha(bytes(x for x, c in zip(b, cover) if not c))))
    return sorted(out, key=str)


def test_suffix_dedup(docs, rows):
    got = dedup_rows(docs)
    assert got == dedup_expected(rows)
    assert sum(r[2] > 0 for r in got) > 15


def test_suffix_dedup_regroups_common_anchors(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", 2)
    assert dedup_rows(docs.select("doc_id", "text")) == dedup_expected(rows)


def test_suffix_dedup_takes_one_of_many_copies(spark, monkeypatch):
    """Copies without ids share a row key: each distinct extent comes once, however many copies there are."""
    rng = random.Random(9)
    texts = [data.prose(rng, 90) for _ in range(6)]
    rows = [(None, t) for t in texts for _ in range(300)] + [(i, t[: 250 + i] + data.prose(rng, 40)) for i, t in enumerate(texts * 2)]
    held = []
    extents = suffix_dedup.extents

    def counted(docs, wanted, length):
        out = extents(docs, wanted, length)
        held.append((wanted.count(), out.count()))
        return out

    monkeypatch.setattr(suffix_dedup, "extents", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert dedup_rows(docs) == dedup_expected(rows)
    assert held and all(got == wanted for wanted, got in held)


def test_suffix_dedup_gathers_no_common_passage(spark, monkeypatch):
    """A passage in different contexts: no task gets more than MANY extents under one key."""
    monkeypatch.setattr(suffix_dedup, "MANY", 8)
    monkeypatch.setattr(suffix_dedup, "MARKS", 500)
    rng = random.Random(6)
    passage = data.prose(rng, 60)
    rows = [(i, data.prose(rng, 40) + passage[: 195 + i] + data.prose(rng, 40)) for i in range(40)]
    most = []
    gather = suffix_dedup.repeated_offsets

    def watched(ranked, length):
        most.append(ranked.groupBy("key").count().agg(F.max("count")).first()[0] or 0)
        return gather(ranked, length)

    monkeypatch.setattr(suffix_dedup, "repeated_offsets", watched)
    assert dedup_rows(spark.createDataFrame(rows, "doc_id long, text string")) == dedup_expected(rows)
    assert len(most) == 1 and most[0] <= 8


@pytest.mark.parametrize("start", [8, 64])
def test_suffix_dedup_by_doubling(docs, rows, start, monkeypatch):
    """Rank pairs of all positions, sorted in Spark, lead to the same cuts."""
    monkeypatch.setattr(suffix_dedup, "repeated_spans", partial(suffix_dedup.doubled_spans, start=start))
    assert dedup_rows(docs) == dedup_expected(rows)


def test_suffix_dedup_empty_and_names(spark, empty):
    assert dedup_rows(empty) == []
    odd = spark.createDataFrame([(None, "q" * 300, 1, 1), (None, None, 2, 2)], "doc_id long, text string, spans int, kept int")
    assert [r[:4] for r in dedup_rows(odd)] == [(None, 0, 0, 0), (None, 300, 300, 1)]
    assert sorted(r.kept for r in suffix_dedup.deduplicated(odd).collect()) == [1, 2]
    cut = suffix_dedup.deduplicated(spark.createDataFrame([(1, "é" * 300, "en", "s", 300)], data.COLUMNS)).first()
    assert (cut.text, cut.n_chars) == ("", 0)


def test_pieces_of_long_texts_cover_all_windows():
    bounds = np.array([0, 10, 700_010, 700_020])
    parts = [p for held in suffix_dedup.pieces(bounds, 200) for p in held]
    starts = sorted(s for _, a, b in parts for s in range(a, b - 199))
    assert starts == list(range(10, 700_010 - 199))


# 2 mixing


def test_pfair_keeps_within_one_block():
    parts = mixing.parts_of([5.0, 3.0, 1.0, 0.01, 2.2], 512)
    assert sum(parts) == 512 and min(parts) >= 1
    slots = mixing.lay_out(parts)
    assert sorted(x for s in slots for x in s) == list(range(512))
    for a, s in zip(parts, slots):
        for t in range(513):
            assert abs(sum(x < t for x in s) - t * a / 512) < 1
        for j, x in enumerate(s):
            assert j * 512 // a <= x < -(-(j + 1) * 512 // a)


def test_mix(spark, docs, rows, empty):
    many = spark.createDataFrame([(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 5}", 1) for i in range(3000)], data.COLUMNS)
    got = mixing.mix(many, block=4, period=128).orderBy("position").collect()
    assert len({r.position for r in got}) == len(got) == 3000
    counts = Counter(r.source for r in got)
    names = [s for s, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    parts = dict(zip(names, mixing.parts_of([(counts[s] / 3000) ** 0.7 for s in names], 128)))
    inside = [r for r in got if r.within_target]
    assert len(inside) > 1000
    for t in range(0, inside[-1].slot + 1, 7):
        for s in names:
            assert abs(len({r.slot for r in inside if r.source == s and r.slot < t}) - t * parts[s] / 128) < 1
    again = mixing.mix(many.repartition(7), block=4, period=128)
    assert {(r.doc_id, r.position) for r in again.collect()} == {(r.doc_id, r.position) for r in got}
    odd = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in odd) == Counter(r[0] for r in rows)
    assert mixing.mix(docs, weights={"hot": 3.0, None: 1.0}, max_sources=2).count() == len(rows)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(docs.withColumn("slot", F.lit("x")).withColumn("_extra", F.lit(1))).count() == len(rows)
    ordered = mixing.in_mixed_order(mixing.mix(many, block=4, period=128), many.columns)
    assert ordered.columns == many.columns and [r.doc_id for r in ordered.collect()] == [r.doc_id for r in got]


def deviation(order, weights):
    """The greatest distance of a source's blocks from slot times weight, after any slot."""
    share = np.array(weights, dtype=float) / sum(weights)
    had = np.cumsum(np.array(order)[:, None] == np.arange(len(weights))[None, :], axis=0)
    return np.abs(had - np.arange(1, len(order) + 1)[:, None] * share).max()


def test_mix_deviates_by_less_than_a_block_from_given_weights(spark):
    for given in ([1.0] * 20, [1.0, 1e-5, 0.3], [x**0.7 for x in range(1, 40)]):
        weights = mixing.whole_weights(given)
        order = mixing.earliest_deadline_first(weights, [40_000 // len(given)] * len(given))
        assert len(order) >= 10_000 and deviation(order, given) < 1
    # One-row blocks: a fixed period of 4,096 slots would lag by more than a block after two of them.
    many = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 20).alias("source"))
    got = mixing.mix(many, block=1).where("within_target").orderBy("position").collect()
    assert len(got) > 39_900 and deviation([int(r.source[1:]) for r in got], [1] * 20) < 1
    with pytest.raises(ValueError):
        mixing.whole_weights([1.0, -1.0])


def test_mix_schedules_each_of_many_sources(spark, monkeypatch):
    rows = [(i, f"h{i % 400:03}" if i % 2 else "hot") for i in range(16_000)]
    many = spark.createDataFrame([*rows, *((20_000 + i, "named") for i in range(30)), (30_000, None)], "doc_id long, source string")
    got = mixing.mix(many, {"hot": 1.0, "named": 0.5, "other": 0.001}, block=1).orderBy("position").collect()
    assert len(got) == len({r.position for r in got}) == 16_031
    inside = [r.source for r in got if r.within_target]
    goal = {s: {"hot": 1.0, "named": 0.5}.get(s, 0.001) for s in {r.source for r in got}}
    assert len(goal) == 203 and inside.count("named") == 30  # a small source keeps its given weight
    names = list(goal)
    assert deviation([names.index(s) for s in inside], list(goal.values())) < 1
    even = mixing.mix(many.where("source LIKE 'h%' AND source <> 'hot'").unionByName(many.select("doc_id", F.concat(F.lit("x"), F.col("doc_id") % 100).alias("source"))), block=1)
    ends = [r.source for r in even.where("within_target").orderBy("position").collect()]
    sizes = Counter(r.source for r in even.select("source").collect())
    assert len(sizes) > 255 and deviation([list(sizes).index(s) for s in ends], [n**0.7 for n in sizes.values()]) < 1
    monkeypatch.setattr(mixing, "BROADCAST_BLOCKS", 0)
    again = mixing.mix(many, {"hot": 1.0, "named": 0.5, "other": 0.001}, block=1, max_sources=3)
    assert {(r.doc_id, r.position) for r in again.collect()} == {(r.doc_id, r.position) for r in got}


# 3 quality rules


def plain_stats(text):
    w = data.WORDS.findall(text or "")
    windows = list(zip(w, w[1:], w[2:]))
    counts = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(3)}
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if data.WORDS.search(x) and x in lines[:i])
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_statistics(rows):
    for _, text, *_ in [*rows, (0, "a b c a b c x a b c\nq\nq\n\n \n#*$"), (0, "a a a a a")]:
        assert textstats.measure(text or "")[:5] == plain_stats(text)


def test_binomial_tail_and_certification():
    exact = sum(math.comb(50, i) * 0.1**i * 0.9 ** (50 - i) for i in range(4))
    assert abs(quality_rules.binomial_tail(3, 50, 0.1) - exact) < 1e-12
    assert quality_rules.certified([0, 0, 0, 100], 0.01, 0.05) == 0  # 100 documents can't show a rate under 1 %
    assert quality_rules.certified([0, 1, 40, 959], 0.01, 0.05) == 2
    assert quality_rules.choose([0, 1, 40, 959], [10, 0, 5, 0], 0.01, 0.05) == 0


def test_certified_cutoffs_limit_false_rejection():
    rng = np.random.default_rng(1)
    wrong = 0
    for _ in range(300):
        p = np.array([0.002, 0.006, 0.012, 0.03])  # true risk of each level
        counts = rng.multinomial(2000, [*np.diff(np.r_[0, p]), 1 - p[-1]])
        level = quality_rules.certified(counts.tolist(), 0.01, 0.05)
        wrong += level > 2
    assert wrong / 300 <= 0.08


def test_quality_rules(spark, rows, empty):
    rng = random.Random(5)
    clean = [(1000 + i, data.prose(rng, 80), "en", "s", 1) for i in range(1500)]
    bad = [(4000 + i, " ".join(w + "***" for w in data.prose(rng, 80).split()), "en", "s", 1) for i in range(200)]
    df = spark.createDataFrame([*rows, *clean, *bad], data.COLUMNS)
    labels = spark.createDataFrame([*((r[0], 1) for r in clean), *((r[0], 0) for r in bad[:100]), (None, 1), (4000, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_rules.judge(df, labels).collect()}
    for d, text, *_ in rows:
        n, chars, symbols, dup, rep = plain_stats(text)
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n) and not (r.kept and r.base_failed)
    assert not any(got[r[0]].kept for r in bad)
    assert sum(not got[r[0]].kept for r in clean) <= 15
    kept = quality_rules.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}
    odd = df.withColumns({"n_words": F.lit("x"), "stratum": F.lit(2)})
    assert quality_rules.keep_good(odd, labels).columns == odd.columns
    none = labels.limit(0)
    assert quality_rules.judge(empty, none).count() == 0
    assert all(r.kept == (not r.base_failed) for r in quality_rules.judge(df.limit(50), none).collect())


def plain_cutoffs(stats, labels, risk, error):
    """The learning of cutoffs by plain loops over all labelled documents."""
    quality = {}
    for d, q in labels:
        if d is not None:
            quality[d] = min(quality.get(d, 9), q or 0)
    rows = [(r, quality[r["doc_id"]]) for r in stats if r["doc_id"] in quality and r["n_words"] >= 50 and 2 * r["n_repeat_words"] <= r["n_words"]]
    own = [s for s, n in Counter(r["lang"] for r, _ in rows if r["lang"]).items() if n >= quality_rules.LEAST_LABELLED]

    def measures(r):
        w, c = max(r["n_words"], 1), max(r["word_chars"], 1)
        return {"symbols": r["n_symbols"] / c, "dup_lines": r["n_dup_lines"] / max(r["n_lines"], 1), "repeats": r["n_repeat_words"] / w, "shouting": r["n_upper"] / w, "digits": r["n_digits"] / c, "marks": r["n_marks"] / c, "sameness": 1 - r["n_distinct"] / w, "word_length": c / w}

    out = {}
    for s in [*own, ""]:
        here = [(measures(r), q, zlib.crc32(f"half {r['doc_id']}".encode()) % 2 == 0) for r, q in rows if (r["lang"] if r["lang"] in own else "") == s]
        tune = [m for m, q, t in here if t and q == 1]
        out[s] = {}
        if not tune:
            continue
        path = []
        for share, factor in quality_rules.LEVELS:
            path.append({n: sorted(m[n] for m in tune)[max(math.ceil(share * len(tune)), 1) - 1] * factor for n in tune[0]})
        good, bad = [0] * (len(path) + 1), [0] * (len(path) + 1)
        for m, q, t in here:
            if not t:
                at = next((i for i, cut in enumerate(path) if any(m[n] > cut[n] for n in cut)), len(path))
                (good if q == 1 else bad)[at] += 1
        certified = 0
        for i in range(len(path)):
            lost, n = sum(good[: i + 1]), sum(good)
            tail = sum(math.comb(n, k) * risk**k * (1 - risk) ** (n - k) for k in range(lost + 1))
            if not n or tail > error / (len(own) + 1):
                break
            certified = i + 1
        if certified:
            most = sum(bad[:certified])
            out[s] = path[next(i for i in range(certified) if sum(bad[: i + 1]) >= 0.99 * most)]
    return out


def test_cutoffs_equal_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "LEAST_LABELLED", 300)
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(1500):
        text, bad = data.prose(rng, rng.randrange(50, 120)), rng.random() < 0.2
        if bad:
            text = " ".join(w.upper() + "##" * rng.randrange(3) if rng.random() < 0.6 else w for w in text.split())
        rows.append((i, text, ("en", "en", "fr", "xx", None)[i % 5], "s", 1))
        labels += [(i, int(not bad))] * (i % 7 != 0)
    df = spark.createDataFrame(rows, data.COLUMNS)
    stats = textstats.statistics(df, ["doc_id", "lang"]).cache()
    known = spark.createDataFrame([*labels, (None, 1), (3, 0)], "doc_id long, quality int")
    for risk, error in ((0.05, 0.2), (0.1, 0.05), (0.01, 0.05)):
        got = quality_rules.learn_cutoffs(stats, known, risk, error)
        want = plain_cutoffs([r.asDict() for r in stats.collect()], [*labels, (3, 0)], risk, error)
        assert got.keys() == want.keys() and "en" in want
        for s in want:
            assert got[s].keys() == want[s].keys() and all(math.isclose(got[s][n], want[s][n]) for n in want[s]), (s, risk)
    assert quality_rules.learn_cutoffs(stats, known, 0.1, 0.05)["en"]


# 4 classifier


def test_ridge_scores_equal_a_direct_solution(spark):
    rng = random.Random(9)
    rows = [(i, data.prose(rng, rng.randrange(20, 90)) + " #9!" * (rng.randrange(8) * (i % 3 == 0)), "en", "s", 1) for i in range(900)]
    truth = {i: int(i % 3 > 0 or rng.random() < 0.2) for i, *_ in rows}
    stats = textstats.statistics(spark.createDataFrame(rows, data.COLUMNS), ["doc_id"]).cache()
    model = classifier.fit(stats, spark.createDataFrame(list(truth.items()), "doc_id long, quality int"), features=64)
    used = [r for r in stats.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4))).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    x = classifier.inputs({n: np.array([r[n] for r in used], dtype=float) for n in textstats.NAMES})
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, np.sqrt(np.maximum(x.var(0), 1e-6)), atol=1e-6)
    fit = np.array([r.part != 0 for r in used])
    z, y = model.features(x[fit]), np.array([truth[r.doc_id] for r in used])[fit]
    # Ridge as least squares with one more row a weight.
    ridge = classifier.RIDGE * len(used) / z.shape[1]
    want = np.linalg.lstsq(np.vstack([z, np.sqrt(ridge) * np.eye(z.shape[1])]), np.r_[y, np.zeros(z.shape[1])], rcond=None)[0]
    assert np.allclose(z @ model.weights, z @ want, atol=1e-6)


def test_isotonic():
    assert classifier.isotonic(np.array([0.0, 2.0, 1.0, 3.0]), np.ones(4)).tolist() == [0.0, 1.5, 1.5, 3.0]


def test_classifier(spark, rows, empty):
    rng = random.Random(7)
    df = [(i, data.prose(rng, rng.randrange(30, 120)) if i % 2 else " ".join(w.upper() + "!!" for w in data.prose(rng, 60).split()), "en", "s", 1) for i in range(1000, 1600)]
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in df] + [(60, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in classifier.score(spark.createDataFrame([*rows, *df], data.COLUMNS), labels).collect()}
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [got[r[0]] for r in df if got[r[0]].held_out]
    assert len(held) > 100 and sum(r.predicted == r.doc_id % 2 for r in held) / len(held) > 0.97
    alone = classifier.score(spark.createDataFrame(rows, data.COLUMNS), labels.limit(0)).collect()
    assert {r.score for r in alone} == {0.5}
    assert classifier.score(empty, labels).count() == 0


# 5, 6, 8 encoding


def test_bpe_equals_the_library(spark, docs, rows, library):
    got = defaultdict(list)
    for r in bpe.round_trip(docs, keep=["doc_id"]).collect():
        got[r.doc_id].append((r.ids, r.decoded))
    for d, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (ids, library.decode(ids, skip_special_tokens=False)) in got[d]
    back = bpe.decode(bpe.encode(docs, keep=["doc_id", "source"]))
    assert back.columns == ["doc_id", "source", "ids", "decoded"] and back.count() == len(rows)


def id_lists(made):
    ids, counts = made
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_bpe_code_points_and_merges(library):
    rng = random.Random(2)
    coder = bpe.WordBpe(bpe.default_path())
    texts = [f"a{chr(i)}b {chr(i)}{chr(i)} x{chr(i)}" for i in range(0x300)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x250), rng.randrange(0x3000), 0x3A3, 0x130, 0x301, 0x212B, 0x85, 0x1C, 0x1F600])) for _ in range(30)) for _ in range(500)]
    texts += ["a" * 3000, "aaab" * 50, "<|startoftext|>Hi<|endoftext|>", "<|STARTOFTEXT|>"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert id_lists(coder.encode(texts)) == want
    coder.forget()
    assert id_lists(coder.encode(texts, coder.library_merge)) == want
    assert id_lists(coder.encode(["", None, " \t", texts[5]])) == [[], [], [], want[5]]


def test_bpe_tables_start_anew(library, monkeypatch, rows):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    monkeypatch.setattr(bpe, "FLAT_SYMBOLS", 7)
    coder = bpe.WordBpe(bpe.default_path())
    for _, text, *_ in rows:
        assert coder.encode([text or ""])[0].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_token_counts(docs, rows, library, empty):
    got = defaultdict(set)
    for r in token_counts.with_limit(docs, limit=100).collect():
        got[r.doc_id].add((r.n_bytes, r.n_tokens, r.over_limit))
    for d, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (len((text or "").encode()), n, n > 100) in got[d]
    assert token_counts.with_limit(empty).count() == 0 and bpe.encode(empty).count() == 0


def test_sorted_tables(spark, docs, rows, library, empty):
    extra = docs.unionByName(spark.createDataFrame([(None, "a b", None, None, None), (-5, "neg", None, None, None)], data.COLUMNS))
    folder = sstable.shard_folder(spark)
    manifest = sstable.write_shards(extra, folder)
    got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in sstable.read_shards(manifest).orderBy("start").collect()]
    want = sorted([*((r[0], r[1]) for r in rows), (None, "a b"), (-5, "neg")], key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert len(got) == len(want)
    for (d, text), g in zip(want, got):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert g == (d, start, len(ids), ids.tobytes())
        start += len(ids)
    few = [(r.doc_id, r.start) for r in sstable.read_shards(sstable.write_shards(extra, sstable.shard_folder(spark), shards=2)).collect()]
    assert sorted(few, key=str) == sorted(((g[0], g[1]) for g in got), key=str)
    one = manifest.orderBy("shard").first()
    fs, at = sstable._filesystem(one.path)
    with fs.open_input_file(at) as f:
        reader = sstable.Reader(f)
        first = next(d for d, *_ in got if d is not None)
        assert reader.get(sstable.key_of(first)) is not None and reader.get(sstable.key_of(10**15)) is None
        assert reader.docs == one.docs
    assert sstable.read_shards(sstable.write_shards(empty, sstable.shard_folder(spark))).count() == 0


def test_sorted_tables_deal_a_hot_identifier(spark, library):
    """An identifier of a third of the rows fills several shards; the order of all rows stays ascending."""
    ids = [7] * 200 + [None] * 50 + [-(1 << 63)] * 50 + list(range(300))
    df = spark.createDataFrame([(d, f"word {i}") for i, d in enumerate(ids)], "doc_id long, text string")
    manifest = sstable.write_shards(df, sstable.shard_folder(spark), shards=9)
    got = sstable.read_shards(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()
    assert max(r.docs for r in manifest.collect()) < 150
    assert sstable._filesystem("file:/x/y")[1] == sstable._filesystem("file:///x/y")[1] == "/x/y"


def test_sorted_table_blocks():
    import io

    out = io.BytesIO()
    w = sstable.Writer(out, 4)
    keys = sorted(sstable.key_of(i * 3 - 500) for i in range(1000))
    for i, k in enumerate(keys):
        w.add(k, np.arange(i % 5, dtype=np.uint32))
    w.close()

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    r = sstable.Reader(File(out.getvalue()))
    assert len(r.index) > 3 and [k for ks, *_ in r.scan() for k in ks] == keys
    assert all(len(r.get(k)) == i % 5 for i, k in enumerate(keys))
    assert sum(r.get(sstable.key_of(i * 3 - 499)) is not None for i in range(1000)) == 0
    damaged = bytearray(out.getvalue())
    damaged[10] ^= 255
    with pytest.raises(ValueError):
        sstable.Reader(File(bytes(damaged))).block(0)


# 7 chat


def test_chat_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", "\\[INST]", "\\\\</s>\\", "<<SYS>>\n[/INST", "", None, "é <s>"]
    rows = [(c, t, ("system", "user", "assistant", "tool", None)[(c + t) % 5], tricky[(c * 3 + t) % 7]) for c in range(9) for t in range(c * 20)]
    rows += [(3, 1, "user", "again"), (3, 1, "user", "again"), (None, 0, "user", "x"), (5, None, "assistant", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.conversations_read_back(df).collect()}
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append(((t is not None, t or 0), role or "", text or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
    assert chat.conversations_read_back(df.limit(0)).count() == 0


def test_chat_turn_order(spark):
    orders = {1: "sua", 2: "ua", 3: "uaua", 4: "au", 5: "uu", 6: "su", 7: "usa", 8: "ua" * 100, 9: "ua" * 70 + "a"}
    names = {"s": "system", "u": "user", "a": "assistant"}
    df = spark.createDataFrame([(c, i, names[x], "t") for c, o in orders.items() for i, x in enumerate(o)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.valid for r in chat.conversations_read_back(df).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: False, 8: True, 9: False}


def test_template_refuses_overlaps():
    with pytest.raises(ValueError):
        chat.Template(roles={"user": chat.Role("<u>", "<u><")}, follows={"": ("user",)}).check()
    chat.DEFAULT.check()


# 9 Jaccard join


@pytest.mark.parametrize("n, threshold", [(3, 90), (5, 80), (2, 60)])
def test_jaccard_components(docs, rows, n, threshold):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs, n, threshold).collect()}
    sets = {r[0]: data.shingle_set(r[1], n) for r in rows}
    want = data.components(sets, threshold)
    assert got == {(d, len(sets[d]), want[d]) for d in sets}


def test_jaccard_chain_links_need_all_pairs(spark):
    """Sets that drift apart step by step: ends don't link, the component holds all."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 5 : i * 5 + 150])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.link_components(df, 3, 90).collect()}
    assert got == data.components({d: data.shingle_set(t, 3) for d, t in rows}, 90)


def test_tree_matches_equals_comparison():
    rng = np.random.default_rng(4)
    pivot = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    sets = []
    for k in range(60):
        s = pivot[rng.random(len(pivot)) > k / 150]
        sets.append(np.unique(np.r_[s, rng.integers(0, 2**63, k // 3).astype(np.uint64)]))
    for threshold in (50, 80, 90, 100):
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, pivot)) >= threshold * len(np.union1d(s, pivot))]
        assert sorted(jaccard_join.tree_matches(pivot, sets, threshold)) == want


def test_range_keys_meet_for_linked_sets():
    rng = np.random.default_rng(5)
    classes = jaccard_join.Classes(90)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**64, rng.integers(1, 400), dtype=np.uint64))
        drop = rng.random(len(a)) > rng.uniform(0, 0.1)
        b = np.unique(np.r_[a[drop], rng.integers(0, 2**64, rng.integers(0, len(a) // 15 + 1), dtype=np.uint64)])
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)):
            assert np.intersect1d(jaccard_join.range_keys(a, classes), jaccard_join.range_keys(b, classes)).size


def test_jaccard_keeps_one(spark, docs, rows, empty):
    kept = jaccard_join.keep_one(docs, 3, 90)
    want = data.components({r[0]: data.shingle_set(r[1], 3) for r in rows}, 90)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, c in want.items() if d == c})
    assert jaccard_join.link_components(empty).count() == 0


def test_jaccard_rows_of_one_or_no_id(spark):
    """Ids with several texts, and rows without an id: one row of each component stays."""
    rng = random.Random(8)

    def near(text, k):
        return " ".join([*text.split()[:-k], *(f"new{k}x{i}" for i in range(k))])

    a, b, c, d, e, f = (data.prose(rng, 150) for _ in range(6))
    rows = [(1, a), (5, near(a, 2)), (5, b)]  # b has no other row
    rows += [(7, c), (7, near(c, 2)), (8, near(c, 3))]  # the least id has two near texts
    rows += [(9, d), *[(None, d)] * 5, (None, near(d, 2))]
    rows += [*[(None, e)] * 4, (None, near(e, 2))]  # no row has an id
    rows += [(20, near(f, 6)), (None, f), (21, " ".join(["head"] * 6 + f.split()[6:]))]  # tied only by a row without id
    rows += [(None, None), (None, " "), (30, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = Counter((r.doc_id, r.text) for r in jaccard_join.keep_one(df, 3, 90).collect())
    assert kept[1, a] == 1 and kept[5, b] == 1 and (5, near(a, 2)) not in kept
    assert sum(k for (i, _), k in kept.items() if i in (7, 8)) == sum(k for (i, _), k in kept.items() if i == 7) == 1
    assert kept[9, d] == 1 and kept[20, near(f, 6)] == 1
    assert sum(k for (i, x), k in kept.items() if i is None and x in (e, near(e, 2))) == 1
    assert kept[None, None] == kept[None, " "] == kept[30, ""] == 1
    assert sum(kept.values()) == 9
    linked = {(r.doc_id, r.component_id) for r in jaccard_join.link_components(df, 3, 90).collect()}
    assert {(20, 20), (21, 20), (None, 20), (None, 9), (8, 7)} <= linked


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(50)] + [(900, 900)]
    got = {r.node: r.root for r in spark_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(sets[a], sets[b])
            changed |= sets[a] != m or sets[b] != m
            sets[a] = sets[b] = m
    assert all(got.get(x, x) == r for x, r in sets.items())


# 10 top-k


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 20)
    rng = random.Random(6)
    rows = [(i, [float(rng.randrange(-3, 4)) / 4 for _ in range(6)], 0) for i in range(120)]
    rows += [(200, None, 0), (250, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (300, [float("nan")] * 6, 0), (350, [float("inf")] * 6, 0), (400, [0.5, 0.5], 0), (50, [0.25] * 6, 0), (450, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(3)
    got = sorted(map(tuple, topk.search(df, df.where("vec_id % 50 = 0")).collect()))
    good = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in good:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q)[:5]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(scored, 1)]
    assert got == sorted(want)
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    """Beyond 64 bits within a sum, and scores that differ in their last digit only."""
    rows = [(50, [2.0**31, 1.0, 2.0**52]), (1, [2.0**31, 1.0, 0.0]), (2, [2.0**31, 2.0, 0.0]), (3, [-(2.0**31), 0.0, 0.0]), (4, [2.0**40, 0.0, -(2.0**19)]), (5, [0.0, 0.00390625, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = [math.floor(256 * x) for x in rows[0][1]]
    want = sorted(((sum(a * math.floor(256 * x) for a, x in zip(q, v)), -i) for i, v in rows[1:]), reverse=True)
    inside = df.where("vec_id NOT IN (1, 2, 3)")
    got = [(r.score, -r.vec_id) for r in topk.search(inside, df.where("vec_id = 50")).orderBy("rank").collect()]
    assert got == [w for w in want if w[1] in (-4, -5)]
    with pytest.raises(Exception, match="(?i)overflow|too large|int64|convert"):
        topk.search(df, df.where("vec_id = 50")).collect()


def test_bit_maps_keep_linked_pairs():
    rng = np.random.default_rng(8)
    for threshold in (60, 80, 90):
        base = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 5, 31, 33, 64, 120, 130, 500)]
        sets = []
        for s in base:
            for _ in range(6):
                keep = rng.random(len(s)) > rng.uniform(0, 0.2)
                sets.append(np.unique(np.r_[s[keep], rng.integers(0, 2**64, rng.integers(0, len(s) // 8 + 1), dtype=np.uint64)]))
        sets = [s for s in sets if len(s)]
        maps, sizes = [jaccard_join.bit_map(s) for s in sets], np.array([len(s) for s in sets])
        edges = jaccard_join.possible_in_cell(np.arange(len(sets)), sizes, maps, threshold)
        root = list(range(len(sets)))
        for a, b in edges:
            old, new = root[b], root[a]
            root = [new if r == old else r for r in root]
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(np.intersect1d(a, b)) >= threshold * len(np.union1d(a, b)):
                    assert root[i] == root[j]
        assert len(edges) < len(sets)
