"""Code mapping and reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A registry has at most a few thousand codes; larger tables are joined without a hint.
REGISTRY_ROWS = 100_000


def registry_side(registry: DataFrame) -> DataFrame:
    """Broadcast a registry after a check of its size."""
    return F.broadcast(registry) if registry.limit(REGISTRY_ROWS + 1).count() <= REGISTRY_ROWS else registry


def map_codes(raw: DataFrame, registry: DataFrame, on: list[str]) -> DataFrame:
    """Source codes to variables, many to one (E1), on one or several columns (E2); unmapped rows go (F2)."""
    return raw.join(registry_side(registry), on)


def map_aliases(raw: DataFrame, aliases: DataFrame, skip: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Channel aliases (E3): mapped rows, and how often each unknown name occurs."""
    mapped = raw.join(registry_side(aliases), on)
    unknown = raw.join(aliases, on, "left_anti").join(skip, on, "left_anti").groupBy(on).count()
    return mapped, unknown


def to_long(wide: DataFrame, keys: list[str], columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """One row per filled cell."""
    return wide.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def to_wide(long: DataFrame, key: str, name: str, value: str, names: list[str], fill: float = 0) -> DataFrame:
    """One column per name, first value, missing ones filled (E5)."""
    return long.groupBy(key).pivot(name, names).agg(F.min(value)).fillna(fill, names)


def renumber(events: DataFrame, old: int, new: int) -> DataFrame:
    """Change a variable's number (E6); again changes nothing."""
    return events.withColumn("var_id", F.when(F.col("var_id") == old, new).otherwise(F.col("var_id")))


def renumber_report(events: DataFrame, old: int, new: int) -> DataFrame:
    return events.agg(F.count_if(F.col("var_id") == old).alias("n_old"), F.count_if(F.col("var_id") == new).alias("n_new"), F.count("*").alias("n"))


def first_rule(text: Column, rules: list[tuple[str, int]]) -> Column:
    """Ordered substring map (E7): the first rule contained in the text wins."""
    out = F.lit(None).cast("int")
    for needle, target in reversed(rules):
        out = F.when(text.contains(needle), target).otherwise(out)
    return out


def list_rows(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows of a list column with their place."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.posexplode(column).alias("place", name))


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text; none of shorter ones or nulls."""
    places = F.when(F.length(text) >= 3, F.sequence(F.lit(1), F.length(text) - 2))
    return F.coalesce(F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.lit(3)))), F.array().cast("array<string>"))


def needed_trigrams(pattern: Column) -> Column:
    """Trigrams that stand in each text a pattern matches.

    Literal runs count, without characters that may be absent; a pattern with groups, classes, counts, escapes or
    alternatives has none.
    """
    bare = F.regexp_replace(pattern, r"(?s).[*?][+?]?", "\n")
    runs = F.transform(F.split(bare, r"[.^$+*?\n]"), trigrams)
    return F.when(pattern.rlike(r"[|(\[{\\]"), F.array().cast("array<string>")).otherwise(F.array_distinct(F.flatten(runs)))


def candidates(dimension: DataFrame, targets: DataFrame, text: str, pattern: str, target: str, most: int = 10) -> DataFrame:
    """Names of a dimension that match each target's pattern, at most ``most`` each, ties in the order of the text.

    Names and patterns meet by one trigram that the pattern needs, the rarest in the dimension; then the pattern is
    tried. Patterns that need none, at most ``REGISTRY_ROWS``, are tried on all names, in an expression over their list. Null names and patterns match nothing.
    """
    wide = [c for c in targets.columns if c in dimension.columns]
    if wide:
        raise ValueError(f"columns of both sides: {wide}")
    asked = targets.where(F.col(pattern).isNotNull()).select(F.struct(*targets.columns).alias("_target"), needed_trigrams(F.col(pattern)).alias("_needed"))
    named = dimension.where(F.col(text).isNotNull())
    offered = named.withColumn("_gram", F.explode(trigrams(F.col(text))))
    grams = asked.select(F.explode("_needed").alias("_gram")).distinct()
    seen = offered.select("_gram").join(registry_side(grams), "_gram").groupBy("_gram").agg(F.count("*").alias("_n"))
    # A trigram that no name has leaves its pattern without a match: it is the rarest.
    counted = asked.withColumn("_gram", F.explode("_needed")).join(seen, "_gram", "left")
    picked = counted.groupBy("_target").agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    columns = [F.col(c) for c in dimension.columns] + [F.col(f"_target.{c}") for c in targets.columns]
    met = offered.join(registry_side(picked), "_gram").select(*columns).where(F.expr(f"{text} rlike {pattern}"))
    few = F.assert_true(F.count(F.lit(1)) <= REGISTRY_ROWS, F.lit("too many patterns without a trigram"))
    open_ones = asked.where(F.size("_needed") == 0).agg(F.when(few.isNull(), F.collect_list("_target")).alias("_all")).scalar()
    tried = named.withColumn("_all", open_ones).withColumn("_target", F.explode(F.filter("_all", lambda t: F.rlike(F.col(text), t[pattern])))).select(*columns)
    hits = met.unionByName(tried)
    return hits.withColumn("place", F.row_number().over(Window.partitionBy(target).orderBy(text))).where(F.col("place") <= most)
