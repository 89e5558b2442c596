"""Quality classifier on document statistics (operator 4).

Random Fourier features approximate a Gaussian kernel over standardised statistics
of a text. Ridge scores come from normal equations that partitions sum up; isotonic
regression on rows kept out of the fit turns scores into probabilities.

Labels are learned from a hash sample of at most about ``sample_rows`` labelled rows,
outside the held-out fold. Every document is scored.

Defined cases: null and empty texts have statistics of 0 and get a score; null
labels aren't learned from, and of contradicting labels of one id the least counts;
with no labels at all, or of one kind only, the score is the share of label 1 (0.5 without
any); repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside.llm.common import remove_written, written
from bedside.llm.textstats import NAMES, statistics

SAMPLE_ROWS = 200_000
FEATURES = 256
RIDGE = 1e-3
FIT_PARTITIONS = 16
SCORE_BINS = 1_000


def held_out() -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def inputs(columns: dict[str, np.ndarray]) -> np.ndarray:
    """The statistics that the kernel sees, one row per document."""
    x = {n: np.asarray(columns[n], dtype=float) for n in NAMES}
    words, chars, lines = np.maximum(x["n_words"], 1), np.maximum(x["word_chars"], 1), np.maximum(x["n_lines"], 1)
    return np.column_stack([
        np.log1p(x["n_words"]),
        x["word_chars"] / words,
        np.sqrt(x["n_symbols"] / chars),
        np.log1p(x["n_symbols"]),
        x["n_dup_lines"] / lines,
        np.log1p(x["n_dup_lines"]),
        x["n_repeat_words"] / words,
        np.log1p(x["n_repeat_words"]),
        x["n_upper"] / words,
        np.sqrt(x["n_digits"] / chars),
        np.sqrt(x["n_marks"] / chars),
        x["n_distinct"] / words,
        np.log1p(words / lines),
    ])


@dataclass
class Model:
    """A few hundred numbers; small whatever the corpus."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.column_stack([np.ones(len(x)), waves])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.any():  # nothing was learned
            return np.full(len(x), self.levels[0])
        raw = self.raw(x)
        # The last term keeps the order of documents within a step of the isotonic fit.
        return np.clip(0.999 * np.interp(raw, self.knots, self.levels) + 0.001 * np.clip(raw, 0, 1), 0, 1)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the closest non-decreasing values."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _table(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {n: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in batch.schema.names}


def fit(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES, ridge: float = RIDGE, seed: int = 7) -> Model:
    """Learn from labelled rows of ``stats`` (doc_id and statistics) outside the held-out fold."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = sample_rows / max(known.count(), sample_rows)
    lot = F.pmod(F.xxhash64(F.lit("lot"), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + (share == 1)
    rows = stats.where(~held_out()).join(known.where(lot), "doc_id").select(*NAMES, F.col("quality").cast("double").alias("quality"), (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) == 0).alias("calibrate"))
    rows = written(rows.repartition(FIT_PARTITIONS), "classifier-rows")

    def moments(batches):
        n, s, q, y = 0, 0.0, 0.0, 0.0
        for b in batches:
            t = _table(b)
            x = inputs(t)
            n, s, q, y = n + len(x), s + x.sum(0), q + (x**2).sum(0), y + t["quality"].sum()
        if n:
            yield pa.RecordBatch.from_pydict({"n": [float(n)], "y": [float(y)], "s": [s.tolist()], "q": [q.tolist()]})

    got = rows.mapInArrow(moments, "n double, y double, s array<double>, q array<double>").collect()
    n, y = sum(r["n"] for r in got), sum(r["y"] for r in got)
    width = inputs({k: np.zeros(1) for k in NAMES}).shape[1]
    rng = np.random.default_rng(seed)
    model = Model(np.zeros(width), np.ones(width), rng.normal(size=(width, features)) / np.sqrt(width) * 1.5, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.array([0.0, 1.0]), np.full(2, y / n if n else 0.5))
    if not 0 < y < n:
        return model
    model.mean = sum(np.array(r["s"]) for r in got) / n
    model.spread = np.sqrt(np.maximum(sum(np.array(r["q"]) for r in got) / n - model.mean**2, 1e-6))

    def equations(batches):
        a, b = 0.0, 0.0
        for batch in batches:
            t = _table(batch)
            z = model.features(inputs(t))
            a, b = a + z.T @ z, b + z.T @ t["quality"]
        if np.ndim(a):
            yield pa.RecordBatch.from_pydict({"row": list(range(len(b))), "a": a.tolist(), "b": b.tolist()})

    def added(table: pa.Table) -> pa.Table:
        a = np.sum(table["a"].to_pylist(), axis=0)
        return pa.table({"row": table["row"][:1], "a": pa.array([a.tolist()]), "b": pa.array([float(np.sum(table["b"].to_numpy()))])})

    shape = "row long, a array<double>, b double"
    sums = sorted(rows.where("NOT calibrate").mapInArrow(equations, shape).groupBy("row").applyInArrow(added, shape).collect())
    if sums:
        a, b = np.array([r["a"] for r in sums]), np.array([r["b"] for r in sums])
        model.weights = np.linalg.solve(a + ridge * n * np.eye(len(b)) / len(b), b)

    def binned(batches):
        for batch in batches:
            t = _table(batch)
            at = np.clip(model.raw(inputs(t)) * SCORE_BINS, -SCORE_BINS, 2 * SCORE_BINS).astype(int)
            yield pa.RecordBatch.from_pydict({"bin": at.tolist(), "y": t["quality"].tolist()})

    bins = rows.where("calibrate").mapInArrow(binned, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("y").alias("n")).orderBy("bin").collect()
    if bins:
        count = np.array([r["n"] for r in bins], dtype=float)
        model.knots = np.array([(r["bin"] + 0.5) / SCORE_BINS for r in bins])
        model.levels = isotonic(np.array([r["y"] for r in bins]) / count, count)
    remove_written(rows)
    return model


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, keep: list[str] | None = None) -> DataFrame:
    """doc_id (and ``keep``), held_out, score and predicted for each row of ``docs``."""
    keep = list(dict.fromkeys(["doc_id", *(keep or [])]))
    stats = written(statistics(docs, keep), "classifier-stats")
    model = fit(stats, labels, sample_rows)
    kinds = dict(stats.dtypes)

    def scored(batches):
        for batch in batches:
            kept = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model.score(inputs(_table(batch.select(NAMES)))))], names=[*keep, "score"])

    out = stats.mapInArrow(scored, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "score double"]))
    return out.withColumns({"held_out": held_out(), "predicted": F.when(F.col("score") >= 0.5, 1).otherwise(0)})
