"""Counts, statistics, coverage and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside.operators.buckets import earlier, meet


def percentiles(df: DataFrame, by: list[str], value: Column, names: dict[str, float], times: Column | None = None, buckets: int = 1024) -> DataFrame:
    """Exact percentiles, linear between ranks, of a group's values that aren't null; no group is one task.

    Equal values are counted first; a row counts ``times``, or once. A value's ranks are running
    sums within equal steps between the group's bounds, plus the counts of the steps below.
    """
    given = df.select(*by, value.cast("double").alias("_v"), (F.lit(1) if times is None else times).alias("_c"))
    counts = given.where("_v IS NOT NULL").groupBy(*by, "_v").agg(F.sum("_c").alias("_c"))
    bounds = counts.groupBy(*by).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_c").alias("_all"))
    v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
    share = F.nanvl((v - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))
    dealt = same_group(counts, bounds, by).withColumn("_bucket", F.coalesce(F.floor(share * buckets), F.lit(0)))
    inside, over = Window.partitionBy(*by, "_bucket").orderBy("_v"), Window.partitionBy(*by).orderBy("_bucket")
    rows = dealt.withColumn("_to", F.sum("_c").over(inside))
    steps = rows.groupBy(*by, "_bucket").agg(F.sum("_c").alias("_n"))
    met = meet(rows, steps, by, {"_below": F.coalesce(F.sum("_n").over(earlier(over)), F.lit(0))})
    end = F.col("_below") + F.col("_to")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < end) & (rank >= end - F.col("_c")), v))

    out = []
    for name, p in names.items():
        place = (F.col("_all") - 1) * p
        weight = F.max(place - F.floor(place))
        a, b = at(F.floor(place)), at(F.ceil(place))
        out.append(F.when(a == b, a).otherwise((1 - weight) * a + weight * b).alias(name))
    return met.groupBy(*by).agg(*out)


def same_group(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """``left`` with the columns of ``right`` for its group, null groups included."""
    renamed = right.withColumnsRenamed({c: f"_group{i}" for i, c in enumerate(by)})
    same = [F.col(c).eqNullSafe(F.col(f"_group{i}")) for i, c in enumerate(by)]
    return left.join(renamed, same, "left").drop(*(f"_group{i}" for i in range(len(by))))


def norm_stats(events: DataFrame, by: str = "var_id", value: str = "value") -> DataFrame:
    """Count, bounds, mean, population deviation and linear percentiles per variable (A5)."""
    stats = events.groupBy(by).agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    return same_group(stats, percentiles(events, [by], F.col(value), {"p01": 0.01, "median": 0.5, "p99": 0.99}), [by])


def event_counts(trajectory: DataFrame, by: list[str]) -> DataFrame:
    """Events per entity, part and variable."""
    return trajectory.groupBy(*by, "part", "var_id").agg(F.count("*").alias("n"))


def coverage(counts: DataFrame, n_entities: int | Column, thresholds: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """Per variable: eligible entities by least number of events, their share, medians over entities that have any."""
    inside = F.when(F.col("part") == "events", F.col("n"))
    total = F.greatest(F.lit(n_entities) if isinstance(n_entities, int) else n_entities, F.lit(1))
    aggs = [F.count_if(inside >= t).alias(f"eligible_{t}") for t in thresholds]
    aggs += [F.round(F.count_if(inside >= t) / total, 4).alias(f"share_{t}") for t in thresholds]
    aggs += [F.coalesce(F.floor(F.percentile(inside, F.lit(0.5))), F.lit(0)).cast("bigint").alias("median_events"), F.coalesce(F.floor(F.percentile(inside, F.lit(0.95))), F.lit(0)).cast("bigint").alias("p95_events"), F.coalesce(F.sum(inside), F.lit(0)).alias("total_events")]
    for p in ("recent", "baseline"):
        n = F.when(F.col("part") == p, F.col("n"))
        aggs += [F.count(n).alias(f"any_{p}"), F.coalesce(F.floor(F.percentile(n, F.lit(0.5))), F.lit(0)).cast("bigint").alias(f"median_{p}")]
    return counts.groupBy("var_id").agg(*aggs).orderBy(F.desc(f"eligible_{thresholds[0]}"), "var_id")


def split_coverage(counts: DataFrame, splits: DataFrame, by: list[str], least: int = 1) -> DataFrame:
    """Eligible entities per split and variable, with a row of all splits."""
    inside = counts.where(F.col("part") == "events").join(splits, by)
    sets = inside.groupingSets([[F.col("split"), F.col("var_id")], [F.col("var_id")]], "split", "var_id")
    counted = sets.agg(F.count_if(F.col("n") >= least).alias("eligible"), F.grouping("split").alias("_all"))
    return counted.select(F.when(F.col("_all") == 1, "all").otherwise(F.col("split")).alias("split"), "var_id", "eligible")


def match_quality(deltas: DataFrame, by: list[str], delta: str = "delta_ms") -> DataFrame:
    """Median, median of absolute values and 5th, 50th and 95th percentiles."""
    counts = deltas.groupBy(*by, delta).agg(F.count("*").alias("_times"))
    n = counts.groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col(delta).isNotNull(), F.col("_times"))), F.lit(0)).alias("n"))
    size = percentiles(counts, by, F.abs(delta), {"median_abs": 0.5}, F.col("_times"))
    signed = percentiles(counts, by, F.col(delta), {"p05": 0.05, "p50": 0.5, "p95": 0.95}, F.col("_times"))
    return same_group(same_group(n, size, by), signed, by)


def better_hypothesis(quality: DataFrame, name: str = "hypothesis") -> DataFrame:
    """The time base of least median absolute difference, the first name of equal ones."""
    return quality.agg(F.min_by(name, F.struct("median_abs", name)).alias(name), F.min("median_abs").alias("median_abs"))


def position(event_ms: Column, start: Column, end: Column) -> Column:
    """Where an event lies against a recording."""
    return F.when(event_ms.isNull(), "none").when(event_ms < start, "before").when(event_ms > end, "after").otherwise("during")


def cadence(samples: DataFrame, code: str, entity: list[str], t: str, first: int = 2000) -> DataFrame:
    """Median step per code (A21): of each entity's first samples the median positive step, then the median over entities.

    Entities with less than three samples of a code aren't probed.
    """
    w = Window.partitionBy(*entity, code).orderBy(t)
    # Ranked alone, so that Spark cuts to the first rows before the exchange as well.
    early = samples.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= first)
    stepped = early.withColumn("_d", F.col(t) - F.lag(t).over(w))
    probed = stepped.groupBy(*entity, code).agg(F.count("*").alias("_k"), F.median(F.when(F.col("_d") > 0, F.col("_d"))).alias("_m"))
    m = F.col("_m")
    return probed.where((F.col("_k") >= 3) & m.isNotNull()).groupBy(code).agg(F.count("*").alias("n_entities"), F.median(m).alias("median_step"), F.min(m).alias("least_step"), F.max(m).alias("greatest_step"))


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Nulls, bounds and distinct values of each column.

    Nulls, bounds and sketches of distinct values come from one aggregate that a table of any width fits; exact counts come from
    (column, value) rows counted by value first, so that neither a column nor a frequent value is one task. Without
    ``exact`` n_distinct is the sketch's estimate and the table is read once. NaN is a value, -0.0 is 0.0.
    """
    stats = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.count_if(F.col(f"`{c}`").isNull()).alias("n_null"), F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias("n_distinct"), F.min(F.col(f"`{c}`")).cast("string").alias("low"), F.max(F.col(f"`{c}`")).cast("string").alias("high")) for c, k in df.dtypes]
    sketched = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    if not exact:
        return sketched
    texts = [F.col(f"`{c}`") + F.lit(0.0).cast(k) if k in ("double", "float") else F.col(f"`{c}`") for c, k in df.dtypes]
    cells = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), x.cast("string").alias("value")) for c, x in zip(df.columns, texts)))).alias("cell")).select("cell.*")
    counts = cells.where("value IS NOT NULL").groupBy("column", "value").agg(F.lit(1).alias("_one")).groupBy("column").agg(F.count("*").alias("_n"))
    kept = sketched.join(counts, "column", "left").withColumn("n_distinct", F.coalesce("_n", F.lit(0)))
    return kept.select(sketched.columns)


def rows_per_year(df: DataFrame, t: str) -> DataFrame:
    """Rows by year of a UTC time in milliseconds (A20); rows without a time have a null year."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col(t) / 86_400_000).cast("int"))
    return df.groupBy(F.year(day).alias("year")).agg(F.count("*").alias("n"))


def frequent(codes: DataFrame, names: DataFrame, code: str, most: int) -> DataFrame:
    """Most frequent codes with their names."""
    counts = codes.groupBy(code).count().orderBy(F.desc("count"), code).limit(most)
    return counts.join(names, code, "left")


def ranked(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first rows by several keys."""
    return df.orderBy(*order).limit(most)


def histogram_of_counts(events: DataFrame, entity: str, what: str) -> DataFrame:
    """Entities per number of distinct values."""
    return events.groupBy(entity).agg(F.count_distinct(what).alias("n_vars")).groupBy("n_vars").agg(F.count("*").alias("n_entities"))


def status_histogram(df: DataFrame, reason: str) -> DataFrame:
    return df.groupBy(reason).agg(F.count("*").alias("n"))  # A14


def class_counts(df: DataFrame, split: str, is_case: str) -> DataFrame:
    """Cases, controls and the share of cases per split."""
    case = F.col(is_case).cast("int")
    return df.groupBy(split).agg(F.sum(case).alias("n_case"), F.sum(1 - case).alias("n_control"), F.round(F.avg(case), 4).alias("case_share"))
