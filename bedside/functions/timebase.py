"""Conversions to the one time base: absolute UTC milliseconds as BIGINT. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_to_ms(text: Column, fmt: str, zone: str) -> Column:
    """Wall time of ``zone`` (X1): an hour that occurs twice is the earlier one, one that a clock change skips is null."""
    wall = F.try_to_timestamp(text, F.lit(fmt))
    utc = F.to_utc_timestamp(wall, zone)
    return F.when(F.from_utc_timestamp(utc, zone) == wall, F.unix_millis(utc))


def zulu_to_ms(text: Column) -> Column:
    """ISO 8601 with Z and optional fraction (X2); a time without zone counts as UTC."""
    return F.unix_millis(F.try_to_timestamp(text))


def first_format_to_ms(text: Column, formats: list[str]) -> Column:
    """The first of several formats that parses."""
    return F.unix_millis(F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats)))


def date_and_time(day: Column, time: Column, blank_time: str = "00:00:00") -> Column:
    """Date and time texts in one (X5): blank times are midnight, dashes in dates are slashes."""
    return F.concat_ws(" ", F.replace(F.trim(day), F.lit("-"), F.lit("/")), F.coalesce(F.nullif(F.trim(time), F.lit("")), F.lit(blank_time)))


def shift_years(ms: Column, years: int) -> Column:
    """Calendar shift of de-identified times (X6); the time of day stays."""
    at = F.timestamp_millis(ms)
    moved = F.add_months(at.cast("date"), F.lit(12 * years))
    return F.unix_millis(moved.cast("timestamp")) + F.pmod(ms, F.lit(86_400_000))


def next_century(start: Column, end: Column, zone: str) -> Column:
    """``end`` of a span whose years have two digits: a century later where that is within a day after ``start``."""
    wall = F.from_utc_timestamp(F.timestamp_millis(end), zone)
    later = F.unix_millis(F.to_utc_timestamp(wall + F.expr("INTERVAL 100 YEARS"), zone))
    return F.when((end < start) & later.between(start, start + 86_400_000), later).otherwise(end)


def shift_days(ms: Column, days: Column) -> Column:
    """Shift back by whole days (X7): ``days`` is the difference of a patient's two offsets."""
    return ms - days.cast("bigint") * 86_400_000


def relative_to_ms(start_s: Column, offset_s: Column) -> Column:
    """Seconds after a start to ms, truncated."""
    return ((start_s + offset_s) * 1000).cast("bigint")


def sample_ms(start_ms: Column, index: Column, fs: Column) -> Column:
    """Time of the index-th sample."""
    return start_ms + F.floor(index * 1000 / fs)


def align(t_ms: Column, window_ms: int, alignment: str) -> tuple[Column, Column]:
    """Window around a label (X23): it ends, is centred or starts there; the half is rounded down."""
    before = {"end": window_ms, "middle": window_ms // 2, "start": 0}[alignment]
    return t_ms - before, t_ms - before + window_ms


def marker_ms(text: Column, fmt: str | None = None) -> Column:
    """Event time of a label text (X24): '-1' means no event."""
    at = F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
    return F.when(F.trim(text) != "-1", F.unix_millis(at))


def has_event(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "-1", F.lit(False))
