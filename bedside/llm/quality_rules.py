"""Quality rules with risk-controlled cutoffs (operator 3).

Fixed base rules come first. Beyond them, cutoffs on statistics of the text are
chosen from labelled documents. In each stratum (a language with enough labels) half of the good labelled
documents lay out a path of cutoffs, from lax to strict: a level of the path puts each
statistic's cutoff at one quantile of those documents. The other half certifies: for
each level an exact binomial test of "the false rejection rate is ``risk`` or more"
must reject. Levels are tested from the lax end and the testing stops at the first
failure, which keeps the error of a stratum; strata share ``error`` by Bonferroni. Of
the certified levels the laxest is taken that still rejects nearly all bad documents
the strictest one does. With too few labels nothing is certified and nothing more is
rejected.

Defined cases: a null text has no words and fails the base; a null language or one of
few labels is in the stratum of others; labels that are null or contradict each other
count as bad; repeated rows each get their verdict; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside.llm.common import remove_written, written
from bedside.llm.textstats import statistics

#: A language with this many labelled documents has cutoffs of its own, the most frequent ones first; all others are one more stratum.
LEAST_LABELLED, MOST_STRATA = 500, 64
OTHER = ""
RISK, ERROR = 0.01, 0.05
#: Levels of the path: the quantile of good documents at which a cutoff stands, and a factor beyond it.
LEVELS = ((1.0, 2.0), (1.0, 1.0), (0.999, 1.0), (0.998, 1.0), (0.996, 1.0), (0.994, 1.0), (0.992, 1.0), (0.99, 1.0))
LEAST_WORDS = 50


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measures() -> dict[str, Column]:
    """Statistics for which more is worse."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "symbols": F.col("n_symbols") / chars,
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "shouting": F.col("n_upper") / words,
        "digits": F.col("n_digits") / chars,
        "marks": F.col("n_marks") / chars,
        "sameness": 1 - F.col("n_distinct") / words,
        "word_length": chars / words,
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exactly summed in logarithms."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(good: list[int], risk: float, error: float) -> int:
    """How many levels, from the lax end, are certified.

    good[i]: good documents first rejected at level i; the last entry: never.
    """
    n, lost = sum(good), 0
    for level, count in enumerate(good[:-1]):
        lost += count
        if n == 0 or lost / n >= risk or binomial_tail(lost, n, risk) > error:
            return level
    return len(good) - 1


def choose(good: list[int], bad: list[int], risk: float, error: float) -> int | None:
    """The level to use: of the certified ones the laxest with 99 % of the rejections of the strictest."""
    last = certified(good, risk, error)
    if not last:
        return None
    hits = [sum(bad[: i + 1]) for i in range(last)]
    return next(i for i, h in enumerate(hits) if h >= 0.99 * hits[-1])


def strata_of(labelled: DataFrame) -> list[str]:
    """Languages of their own, from the labelled documents."""
    counts = labelled.where("lang IS NOT NULL").groupBy("lang").count().where(F.col("count") >= LEAST_LABELLED)
    return [r["lang"] for r in counts.orderBy(F.desc("count"), "lang").limit(MOST_STRATA).collect()]


def stratum(strata: list[str], lang: str = "lang") -> Column:
    """``lang`` where it has cutoffs of its own; the empty name is that of all others."""
    return F.when(F.col(lang).isin(*strata), F.col(lang)).otherwise(OTHER) if strata else F.lit(OTHER)


def learn_cutoffs(stats: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[str, dict[str, float]]:
    """Cutoffs by stratum and measure, none where nothing was certified. ``stats``: doc_id, lang and statistics; ``labels``: doc_id, quality.

    What comes to the driver are quantiles and counts by stratum and level, whose number is fixed.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality"))
    m = measures()
    good = stats.where(~base_failed()).join(known, "doc_id")
    strata = strata_of(good)
    rows = good.select("doc_id", stratum(strata).alias("stratum"), *(c.alias(n) for n, c in m.items()), "quality")
    rows = rows.withColumn("tuning", F.pmod(F.crc32(F.concat(F.lit("half "), F.col("doc_id").cast("string"))), F.lit(2)) == 0)
    quantiles = sorted({q for q, _ in LEVELS})
    tuned = rows.where("tuning AND quality = 1").groupBy("stratum").agg(*(F.percentile_approx(n, quantiles, 10_000).alias(n) for n in m)).collect()
    paths = {r["stratum"]: [{n: r[n][quantiles.index(q)] * f for n in m} for q, f in LEVELS] for r in tuned}
    out: dict[str, dict[str, float]] = {s: {} for s in [*strata, OTHER]}
    if not paths:
        return out
    level = F.lit(len(LEVELS))
    for s, path in paths.items():
        first = F.lit(len(LEVELS))
        for i in reversed(range(len(path))):
            first = F.when(_beyond(path[i]), i).otherwise(first)
        level = F.when(F.col("stratum") == s, first).otherwise(level)
    counts: dict = defaultdict(lambda: ([0] * (len(LEVELS) + 1), [0] * (len(LEVELS) + 1)))
    for r in rows.where("NOT tuning").select("stratum", level.alias("level"), "quality").groupBy("stratum", "level", "quality").count().collect():
        counts[r["stratum"]][0 if r["quality"] == 1 else 1][r["level"]] += r["count"]
    for s, path in paths.items():
        at = choose(*counts[s], risk, error / (len(strata) + 1))
        if at is not None:
            out[s] = path[at]
    return out


def _beyond(cutoffs: dict[str, float]) -> Column:
    out = F.lit(False)
    for n, c in cutoffs.items():
        out = out | (F.col(n) > F.lit(float(c)))
    return out


def rejected(cutoffs: dict[str, dict[str, float]]) -> Column:
    """True where a document of ``stratum`` with the columns of ``measures`` is beyond a cutoff."""
    out = F.lit(False)
    for s, c in cutoffs.items():
        out = F.when(F.col("stratum") == s, _beyond(c)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, keep: list[str] | None = None) -> DataFrame:
    """Statistics and verdict of each document: doc_id, the statistics, stratum, base_failed, kept."""
    keep = list(dict.fromkeys(["doc_id", "lang", *(keep or [])]))
    stats = written(statistics(docs, keep), "quality-stats")
    cutoffs = learn_cutoffs(stats, labels, risk, error)
    m = measures()
    out = stats.withColumns({"stratum": stratum(list(cutoffs)), "base_failed": base_failed(), **m})
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(rejected(cutoffs), F.lit(False))).drop(*m)


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The documents that the rules keep, with their own columns; texts are measured where they are read."""
    columns = docs.columns
    m = measures()
    known = labels.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    labelled = written(statistics(docs.select("doc_id", "lang", "text").join(known, "doc_id", "left_semi"), ["doc_id", "lang"]), "quality-labelled")
    cutoffs = learn_cutoffs(labelled, labels, risk, error)
    remove_written(labelled)
    # Under numbered names, columns of the table can't be mistaken for statistics.
    plain = {c: f"_c{i}" for i, c in enumerate(columns)}
    judged = statistics(docs.toDF(*plain.values()), list(plain.values()), plain["text"]).withColumns({"stratum": stratum(list(cutoffs), plain["lang"]), **m})
    kept = judged.where(~base_failed() & ~F.coalesce(rejected(cutoffs), F.lit(False)))
    return kept.select(*(F.col(p).alias(c) for c, p in plain.items()))
