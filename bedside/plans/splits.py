"""Leakage-safe splits in a repeatable hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lot(key: Column, seed: int) -> Column:
    """Order of the draw: the digest of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def assign(groups: DataFrame, key: str, shares: tuple[float, float], seed: int = 42, strata: list[str] | None = None, floor_test_first: bool = False) -> DataFrame:
    """``groups`` (one row per patient or entity) with split.

    train and val have round(n * share) groups, half to even, test the rest; or, with
    ``floor_test_first``, test and val have the floor of their shares. Draws are ranked
    by hash within a bucket of the hash and buckets are counted, so one stratum isn't
    one task.
    """
    by = strata or []
    dealt = groups.withColumn("_lot", lot(F.col(key), seed)).withColumn("_bucket", F.substring("_lot", 1, 2))
    counts = dealt.groupBy(*by, "_bucket").count()
    across = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    counts = counts.withColumns({"_before": F.sum("count").over(across.orderBy("_bucket")) - F.col("count"), "_n": F.sum("count").over(across)}).drop("count")
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_lot", key)) - 1
    ranked = dealt.withColumn("_in", place).join(counts, [*by, "_bucket"]).withColumn("_place", F.col("_before") + F.col("_in"))
    n, p = F.col("_n"), F.col("_place")
    a, b = shares
    if floor_test_first:
        n_test, n_val = F.floor(n * a), F.floor(n * b)
        split = F.when(p < n_test, "test").when(p < n_test + n_val, "val").otherwise("train")
    else:
        n_train, n_val = F.bround(n * a), F.bround(n * b)
        split = F.when(p < n_train, "train").when(p < n_train + n_val, "val").otherwise("test")
    return ranked.withColumn("split", split).drop("_lot", "_bucket", "_before", "_n", "_in", "_place")


def grouped(entities: DataFrame, entity: str, patient: str, shares: tuple[float, float], seed: int = 42, stratum: str | None = None, unknown: str = "unknown") -> DataFrame:
    """Entities with the split of their patient; entities without a patient are one group."""
    keyed = entities.withColumn("_patient", F.coalesce(F.col(patient).cast("string"), F.lit(unknown)))
    one = keyed.groupBy("_patient").agg(*([F.max(stratum).alias(stratum)] if stratum else [F.count("*").alias("_k")]))
    split = assign(one, "_patient", shares, seed, [stratum] if stratum else None)
    return keyed.join(split.select("_patient", "split"), "_patient").drop("_patient")


def adopt(published: dict[str, DataFrame], valid: DataFrame, key: str) -> DataFrame:
    """Published split lists cut down to valid entities."""
    out = None
    for name, ids in published.items():
        part = ids.join(valid, key, "left_semi").select(key, F.lit(name).alias("split"))
        out = part if out is None else out.unionByName(part)
    return out


def inherit(members: DataFrame, splits: DataFrame, key: str) -> DataFrame:
    """A task's entities with the splits of the cohort they came from."""
    return members.join(splits.select(key, "split"), key)


def balanced_pick(entities: DataFrame, strata: list[str], key: str, n: int, seed: int = 42) -> DataFrame:
    """N entities dealt from the strata in turn."""
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(lot(F.col(key), seed), key))
    # No stratum gives more than n, so Spark cuts each to n before the exchange as well.
    return entities.withColumn("turn", place).where(F.col("turn") <= n).orderBy("turn", *strata).limit(n)


def filled_pick(entities: DataFrame, listed: DataFrame, strata: list[str], key: str, n: int, seed: int = 42) -> DataFrame:
    """N entities dealt from the strata of those listed; where these are too few, the others fill up by lot.

    ``listed`` has the keys of a split list, repeats and nulls without effect. Keys of ``entities`` are distinct. Fewer than n rows
    mean fewer than n entities.
    """
    known = listed.select(key).where(F.col(key).isNotNull()).distinct().withColumn("listed", F.lit(True))
    marked = entities.join(known, key, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    inside = balanced_pick(marked.where("listed"), strata, key, n, seed)
    others = sample_n(marked.where("NOT listed"), key, n, seed).withColumn("turn", F.lit(None).cast("int"))
    # Both sides are at most n rows, so one order over them is small.
    both = inside.unionByName(others)
    dealt = [F.when(F.col("listed"), F.col(c)) for c in ("turn", *strata)]
    return both.orderBy(F.desc("listed"), *dealt, lot(F.col(key), seed), key).limit(n)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return df.orderBy(lot(F.col(key), seed), key).limit(n)  # O9
