"""Statistics of whole texts that the quality operators share."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from bedside.llm.common import WORD_PATTERN, map_text

WORDS = re.compile(WORD_PATTERN)
SPACES = re.compile(r"[\x20\x09-\x0D]")
SYMBOLS = re.compile(r"[#*$%&|<>]")

SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_upper bigint, n_digits bigint, n_marks bigint, n_distinct bigint"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
MARKS = re.compile(r"[!?;:=+~^_@/\\{}\[\]()\"]")
DIGITS = re.compile(r"[0-9]")


def repeated_words(words: list[str]) -> int:
    """Words covered by a window of three words that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: set[tuple] = set()
    twice: set[tuple] = set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered, last = 0, -1  # the last covered word
    for i, w in enumerate(windows):
        if w in twice:
            covered += i + 2 - max(last, i - 1)
            last = i + 2
    return covered


def measure(text: str) -> tuple[int, ...]:
    """One text's statistics, in the order of NAMES."""
    words = WORDS.findall(text)
    lines = text.split("\n")
    dups = 0
    if len(lines) > 1:
        seen: set[str] = set()
        for line in lines:
            if line in seen:
                dups += WORDS.search(line) is not None
            else:
                seen.add(line)
    return (
        len(words),
        len(text) - len(SPACES.findall(text)),
        len(SYMBOLS.findall(text)),
        dups,
        repeated_words(words),
        len(lines) if text else 0,
        sum(map(str.isupper, words)),
        len(DIGITS.findall(text)),
        len(MARKS.findall(text)),
        len(set(words)),
    )


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` plus the statistics of each whole text; null texts count as empty."""

    def make():
        def work(texts: list[str]) -> dict[str, pa.Array]:
            columns = list(zip(*map(measure, texts)))
            return {n: pa.array(c, pa.int64()) for n, c in zip(NAMES, columns)}

        return work

    return map_text(docs, keep, text, make, SCHEMA)
