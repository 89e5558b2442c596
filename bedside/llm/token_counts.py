"""Token counts without token ids (operator 6).

Texts become frequencies of their pre-tokens. The pieces of a pre-token are counted
once: those of pre-tokens that a bounded sample of documents holds repeatedly in a table
that is broadcast, those of all others in a table with one row for each distinct one.
Frequencies are joined to both, and the products are summed by document.

The sample only settles where a pre-token is counted; any sample gives the same result.
What is shuffled are the frequencies of rare pre-tokens, one row a document and pre-token.

Defined cases: null and empty texts count 0; special strings inside texts are one
token each, as in the library; repeated rows are counted each; columns named n_tokens give
way to the result's, and other columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.llm.bpe import SLICE_BYTES, WordBpe, coder, default_path, spread
from bedside.llm.common import no_cycle_collection, slices, written

#: Documents of the sample, about, and pre-tokens of the table that is broadcast, at most.
SAMPLE_ROWS, FREQUENT = 20_000, 300_000


def frequencies(words: WordBpe, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Row, pre-token (its place in a list of distinct ones) and frequency of each pair; sorted by row."""
    chunks, starts, sizes = words.chunked(pc.fill_null(texts, ""))
    coded = chunks.dictionary_encode()
    number: dict[str, int] = {}
    # Special strings stand alone as chunks and count as pre-tokens of their own.
    split = [[c] if c in words.special else words.split(c) for c in coded.dictionary.to_pylist()]
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.array([number.setdefault(w, len(number)) for each in split for w in each], dtype=np.int64)
    codes = np.asarray(coded.indices)[spread(starts, sizes)]
    counts = lengths[codes]
    tokens = flat[spread((np.cumsum(lengths) - lengths)[codes], counts)]
    rows = np.repeat(np.repeat(np.arange(len(texts)), sizes), counts)
    pairs, times = np.unique(rows * len(number) + tokens, return_counts=True) if number else (rows, rows)
    width = max(1, len(number))
    return pairs // width, list(number), pairs % width, times


def piece_counts(words: WordBpe, tokens: list[str]) -> np.ndarray:
    """How many pieces each pre-token has."""
    out = np.ones(len(tokens), dtype=np.int64)
    plain = [i for i, t in enumerate(tokens) if t not in words.special]
    if plain:
        out[plain] = words.merge([tokens[i] for i in plain])[1]
    return out


def counted(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (pre_token, distinct) with n_pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        for batch in batches:
            n = piece_counts(words, batch["pre_token"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["pre_token"], pa.array(n)], names=["pre_token", "n_pieces"])

    return tokens.select("pre_token").mapInArrow(run, "pre_token string, n_pieces long")


def frequent_pieces(df: DataFrame, path: str, text: str, sample_rows: int, most: int) -> dict[str, int]:
    """Pieces of the pre-tokens that several documents of a sample hold, ``most`` at most."""
    share = sample_rows / max(df.count(), sample_rows)
    lot = F.pmod(F.xxhash64(F.lit("lot"), text), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        for part in slices(batches, text, SLICE_BYTES):
            _, tokens, which, _ = frequencies(words, part[text])
            yield pa.RecordBatch.from_pydict({"pre_token": pa.array(tokens, pa.string()), "n": np.bincount(which, minlength=len(tokens))})

    # Copies of one text are in the sample together: of each text one is enough.
    seen = df.where(lot).select(text).distinct().mapInArrow(run, "pre_token string, n long")
    top = seen.groupBy("pre_token").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pre_token").limit(most)
    return {r["pre_token"]: r["n_pieces"] for r in counted(top, path).collect()}


def count_tokens(df: DataFrame, path: str | None = None, text: str = "text", keep: list[str] | None = None, sample_rows: int = SAMPLE_ROWS, most: int = FREQUENT) -> DataFrame:
    """``keep`` (default: all columns) plus ``n_tokens``."""
    path = path or default_path()
    keep = [c for c in (keep if keep is not None else df.columns) if c != "n_tokens"]
    kinds = dict(df.dtypes)
    plain = {c: f"_c{i}" for i, c in enumerate(keep)}
    source = df.select(F.col(f"`{text}`").alias("_text"), *(F.col(f"`{c}`").alias(p) for c, p in plain.items()))
    known = df.sparkSession.sparkContext.broadcast(frequent_pieces(source, path, "_text", sample_rows, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycle_collection():
            words, table = coder(path), known.value
            for part in slices(batches, "_text", SLICE_BYTES):
                rows, tokens, which, times = frequencies(words, part["_text"])
                pieces = np.fromiter((table.get(t, 0) for t in tokens), np.int64, len(tokens))[which]
                sums = np.bincount(rows, weights=pieces * times, minlength=part.num_rows).astype(np.int64)
                rare = np.flatnonzero(pieces == 0)
                ends = np.r_[0, np.cumsum(np.bincount(rows[rare], minlength=part.num_rows))].astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(tokens, pa.string()).take(pa.array(which[rare])), pa.array(times[rare])], ["pre_token", "n"])
                yield pa.RecordBatch.from_arrays([*(part[p] for p in plain.values()), pa.array(sums), pa.ListArray.from_arrays(pa.array(ends), pairs)], names=[*plain.values(), "known", "rare"])

    shape = ", ".join([*(f"{p} {kinds[c]}" for c, p in plain.items()), "known long, rare array<struct<pre_token: string, n: long>>"])
    # Row numbers hold once the rows are files.
    table = written(source.mapInArrow(run, shape).withColumn("_row", F.monotonically_increasing_id()), "frequencies")
    spelled = table.select("_row", F.explode("rare").alias("r")).select("_row", "r.pre_token", "r.n")
    pieces = written(counted(spelled.select("pre_token").distinct(), path), "pieces")
    others = spelled.join(pieces, "pre_token").groupBy("_row").agg(F.sum(F.col("n") * F.col("n_pieces")).alias("others"))
    out = table.select("_row", "known", *plain.values()).join(others, "_row", "left")
    return out.select(*(F.col(p).alias(c) for c, p in plain.items()), (F.col("known") + F.coalesce("others", F.lit(0))).alias("n_tokens"))


def with_limit(df: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the count is over ``limit``."""
    sized = df.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(sized, path, keep=["doc_id", "n_bytes"]).withColumn("over_limit", F.col("n_tokens") > limit)
