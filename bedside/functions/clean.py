"""Cleaning of raw values, and the predicates that every source shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numeric_text(text: Column) -> Column:
    """Number in a result text (X10): comparison and unit signs around it go, so '<5' is 5; otherwise null."""
    return finite_or_null(F.btrim(F.trim(text), F.lit("<>=~%+ ")).try_cast("double"))


def safe_int(text: Column) -> Column:
    """Whole number or null (X22); a text such as '3.0' counts as 3."""
    return finite_or_null(text.try_cast("double")).try_cast("bigint")


def safe_float(text: Column) -> Column:
    return finite_or_null(text.try_cast("double"))


def finite(value: Column) -> Column:
    """Not null, not NaN, not infinite (F4). NaN is tested first: Spark orders it above every number."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def finite_or_null(value: Column) -> Column:
    return F.when(finite(value), value)


def in_physio_range(value: Column, low: Column, high: Column) -> Column:
    """Inclusive range (F5); a range with one bound only isn't applied."""
    return F.when(low.isNotNull() & high.isNotNull(), value.between(low, high)).otherwise(True)


def null_tokens(df: DataFrame, tokens: list[str], columns: list[str] | None = None) -> DataFrame:
    """Several texts that mean null."""
    return df.withColumns({c: F.when(~F.trim(F.col(c)).isin(*tokens), F.col(c)) for c in columns or df.columns})


def above_zero(value: Column) -> Column:
    """Monitor numerics (F7): zero and negative numbers mean missing."""
    return value > 0


def chart_vital(value: Column, var_id: Column, spo2: int = 101) -> Column:
    """Charted vitals (F8): no negative values, no SpO2 of 0."""
    return (value >= 0) & ~((var_id == spo2) & (value == 0))


def sane(value: Column, bound: float = 1e6) -> Column:
    """Wide bounds, exclusive."""
    return (value > -bound) & (value < bound)


def mentions(text: Column, word: str) -> Column:
    """Case-insensitive match (F10); a null text is in neither branch."""
    return F.lower(text).contains(word.lower())


def band(var_id: Column, category: str) -> Column:
    """Variables of one category by the range of their ids."""
    from bedside.schemas import BANDS

    low, high = BANDS[category]
    return var_id.between(low, high)


def valid_interval(start: Column, end: Column, strict: bool = False) -> Column:
    return end > start if strict else end >= start  # F12


def bounded_end(start: Column, end: Column, longest: int) -> Column:
    return F.least(end, start + longest)  # F13


def within(t: Column, start: Column, end: Column) -> Column:
    return (t >= start) & (t < end)  # F14


def label_clip(value: Column, low: float | None, high: float | None) -> Column:
    """Labels inside [low, high] (F15); NaN never passes."""
    ok = finite(value)
    if low is not None:
        ok = ok & (value >= low)
    return ok & (value <= high) if high is not None else ok


def code_text(text: Column) -> Column:
    return F.upper(F.trim(text))  # X11


def fahrenheit(value: Column, conversion: Column) -> Column:
    return F.when(conversion == "F_to_C", (value - 32) * 5 / 9).otherwise(value)  # X15


def fraction(value: Column) -> Column:
    """Percent to fraction (X16), whatever the value: a range rule drops what wasn't percent."""
    return value / 100


def age(birth: Column, at: Column) -> Column:
    """Years of 365.25 days in [0, 89], two places, half to even."""
    return F.bround(F.least(F.greatest(F.datediff(at, birth) / 365.25, F.lit(0.0)), F.lit(89.0)), 2)


def garbled_label(text: Column, known: list[str]) -> Column:
    """The last word of a label that was run into its unit (X14), if that word is a known label; a null label is empty."""
    last = F.element_at(F.split(text, " "), -1)
    return F.when(text.isNull(), "").when(F.startswith(text, F.lit("C ")) & last.isin(*known), last).otherwise(text)


def min_max(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest((value - low) / (high - low + 1e-8), F.lit(0.0)), F.lit(1.0))  # X21


def valid_samples(samples: Column, low: Column, high: Column, gain: Column, offset: Column, sentinels: tuple[float, float] | None = None, offset_first: bool = False) -> Column:
    """Scaled samples with NaN for sentinels and for scaled values out of range.

    Raw samples at or below the first sentinel, or at or above the second, are missing.
    A range with one bound only isn't applied. One family of monitors scales
    raw * gain + offset, another gain * (raw + offset).
    """
    nan = F.lit(float("nan")).cast("float")

    def one(x: Column) -> Column:
        scaled = (gain * (x + offset) if offset_first else x * gain + offset).cast("float")
        bad = F.isnan(x) | F.coalesce(low.isNotNull() & high.isNotNull() & ((scaled < low) | (scaled > high)), F.lit(False))
        if sentinels:
            bad = bad | (x <= sentinels[0]) | (x >= sentinels[1])
        return F.when(bad, nan).otherwise(scaled)

    return F.transform(samples, one)


def padded_id(value: Column, width: int, prefix: str = "") -> Column:
    """Zero-padded id with a prefix (X12); a longer id stays whole."""
    text = value.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def without_prefix(text: Column, prefix: str) -> Column:
    return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, F.lit(len(prefix) + 1), F.length(text))).otherwise(text)


def file_parts(path: Column, pattern: str, names: list[str]) -> list[Column]:
    """Groups of a file name pattern as columns, null where it doesn't match."""
    return [F.nullif(F.regexp_extract(path, pattern, i), F.lit("")).alias(n) for i, n in enumerate(names, 1)]


def hours_between(start_ms: Column, end_ms: Column) -> Column:
    return (end_ms - start_ms) / 3_600_000  # X19
