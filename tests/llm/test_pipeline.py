"""The pipeline against plain Python, stage by stage."""

import random
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from bedside.llm import bpe, mixing  # noqa: E402
from tests.llm import data  # noqa: E402


def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    good = [(1000 + i, data.prose(rng, 80), "en", "s", 1) for i in range(1200)]
    rows = [(*r, f"k{r[0]}") for r in [*data.corpus(), *good]]
    spark.createDataFrame(rows, data.COLUMNS + ", kept string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, 0) for r in good], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        at = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(at)
        before, docs = docs, spark.read.parquet(at)
        seen[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.dtypes == before.dtypes
    names = [n for n, _ in corpus_pipeline.STAGES]
    kept = seen[names[0]]
    ids = {r.doc_id for r in kept}
    assert sum(r[0] not in ids for r in good) <= 12
    for d, text, *_ in rows:
        w = data.WORDS.findall(text or "")
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
        if len(w) < 50 or 100 * len(covered) > 50 * len(w):
            assert d not in ids
    want = data.components({r.doc_id: data.shingle_set(r.text, 5) for r in kept}, 80) if len(kept) < 60 else None
    single = seen[names[1]]
    groups = data.components({r.doc_id: data.shingle_set(r.text, 5) for r in kept if r.doc_id < 1000}, 80)
    assert sorted(r.doc_id for r in single if r.doc_id < 1000) == sorted({d for d, c in groups.items() if d == c})
    assert want is None or want
    cut = {r.doc_id: r.text for r in seen[names[2]]}
    for r, cover in zip(single, data.removed([r.text for r in single], 200)):
        b = (r.text or "").encode()
        assert cut[r.doc_id] == (bytes(x for x, c in zip(b, cover) if not c).decode("utf-8", "ignore") if any(cover) else r.text)
    assert {r.doc_id: r.text for r in seen[names[3]]} == cut
    assert all(r.kept == f"k{r.doc_id}" for r in seen[names[3]])
    library = bpe.WordBpe(bpe.default_path()).library
    for r in seen[names[4]]:
        assert r.ids == library.encode(cut[r.doc_id] or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_result_is_in_mixed_order(spark, tmp_path, monkeypatch):
    """The last stages over several files of very different sizes, read back as any reader does."""
    rng = random.Random(3)
    rows = [(i, data.prose(rng, 400 if i % 50 == 0 else 5), "en", "hot" if i % 3 else f"s{i % 5}", 1) for i in range(600)]
    spark.createDataFrame(rows, data.COLUMNS).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = [(r.doc_id, r.source, r.position) for r in mixing.mix(docs).orderBy("position").collect()]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.source, r.position) for r in got] == want
    stage = corpus_pipeline.mixing_stage(spark, docs, str(tmp_path))
    assert [r.doc_id for r in stage.collect()] == [r.doc_id for r in got]
