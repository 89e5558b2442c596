"""Delimited text exports: everything is read as text and cast with tolerance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedside.functions.clean import null_tokens


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_delimited(spark: SparkSession, path: str | list[str], columns: list[str], tokens: list[str] = ["", "NA", "\\N"], sep: str = ",", skip_malformed: bool = False, partitions: int | None = None) -> DataFrame:  # noqa: B006
    """Files or globs, plain or gzip (S1-S5, S18); ``partitions`` spreads files that can't be split."""
    reader = spark.read.schema(text_schema(columns)).option("header", True).option("sep", sep).option("mode", "DROPMALFORMED" if skip_malformed else "PERMISSIVE").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    df = reader.csv(path)
    return null_tokens(df.repartition(partitions) if partitions else df, tokens)


def read_with_header(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Header names trimmed, required columns checked, malformed rows skipped."""
    df = spark.read.option("header", True).option("mode", "DROPMALFORMED").csv(path)
    df = df.toDF(*(c.strip() for c in df.columns))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return df


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Tolerant casts (S3): what doesn't parse is null."""
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items()})


def read_dirty_csv(spark: SparkSession, path: str, columns: list[str], encoding: str = "ISO-8859-1", fold_into: int | None = None, drop_phrase_commas: bool = False) -> DataFrame:
    """Lines with stray commas.

    Fields beyond the expected number are folded into column ``fold_into`` (default:
    the last one). Commas inside quotes stay. With ``drop_phrase_commas`` a comma
    after a non-numeric phrase and a blank goes first, which may also eat separators.
    """
    lines = spark.read.option("encoding", encoding).option("sep", "\u0001").option("quote", "").schema("line string").csv(path)
    return repair_lines(lines, "line", columns, fold_into, drop_phrase_commas)


def _rejoined(text: Column, stray: Callable[[Column, Column], Column]) -> Column:
    """The text without the commas that are ``stray`` between what is before and what is after them."""
    pieces = F.split(text, ",")

    def with_comma(piece: Column, i: Column) -> Column:
        following = F.get(pieces, i + 1)
        return F.concat(piece, F.when(following.isNull() | stray(piece, following), "").otherwise(","))

    return F.array_join(F.transform(pieces, with_comma), "")


def without_thousands(text: Column) -> Column:
    """Numbers without their first thousands separator; a number at the very start of a line keeps it.

    Such a comma has up to three digits before it, which don't begin their field, and just three after it.
    """
    return _rejoined(text, lambda p, q: p.rlike("[^0-9][0-9]{1,3}$") & q.rlike("^[0-9]{3}([^0-9]|$)"))


def without_phrase_commas(text: Column) -> Column:
    """Fields that end in a phrase lose the comma after it; one that ends in blanks, a quote or a plain number keeps it.

    A phrase is what comes after the last quote or wider blank and has a letter, or a sign right after a digit.
    """

    def stray(piece: Column, _: Column) -> Column:
        tail = F.element_at(F.split(piece, r"\"|\s\s"), -1)
        return tail.rlike(r"\S$") & tail.rlike(r"[A-Za-z_]|[0-9][^0-9A-Za-z_\s]")

    return _rejoined(text, stray)


def without_stray_commas(text: Column) -> Column:
    """Commas that aren't field separators go: in numbers, then after phrases."""
    return without_phrase_commas(without_thousands(text))


def repair_lines(lines: DataFrame, line: str, columns: list[str], fold_into: int | None = None, drop_phrase_commas: bool = False) -> DataFrame:
    at = len(columns) - 1 if fold_into is None else fold_into
    text = F.col(line)
    if drop_phrase_commas:
        text = without_stray_commas(text)
    zero = F.array().cast("array<string>")
    # A piece with an odd number of quotes opens or closes a quoted field.
    step = F.aggregate(
        F.split(text, ","),
        F.struct(zero.alias("done"), F.lit(None).cast("string").alias("open")),
        lambda a, p: F.when(a["open"].isNull() & (F.length(p) - F.length(F.replace(p, F.lit('"'), F.lit(""))) == 1), F.struct(a["done"].alias("done"), p.alias("open")))
        .when(a["open"].isNull(), F.struct(F.concat(a["done"], F.array(p)).alias("done"), a["open"].alias("open")))
        .when(p.contains('"'), F.struct(F.concat(a["done"], F.array(F.concat_ws(",", a["open"], p))).alias("done"), F.lit(None).cast("string").alias("open")))
        .otherwise(F.struct(a["done"].alias("done"), F.concat_ws(",", a["open"], p).alias("open"))),
        lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))),
    )
    fields = lines.withColumn("_f", step).withColumn("_extra", F.greatest(F.size("_f") - len(columns), F.lit(0)))

    def field(i: int):
        if i < at:
            return F.get("_f", F.lit(i))
        if i == at:
            return F.when(F.size("_f") > at, F.array_join(F.slice("_f", F.lit(at + 1), F.col("_extra") + 1), ","))
        return F.get("_f", F.lit(i) + F.col("_extra"))

    kept = fields.select(*(F.trim(F.replace(field(i), F.lit('"'), F.lit(""))).alias(c) for i, c in enumerate(columns)))
    header = F.lit(True)
    for c in columns:
        header = header & (F.lower(F.coalesce(c, F.lit(""))) == c.lower())
    return kept.where(~header)
