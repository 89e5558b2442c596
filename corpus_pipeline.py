"""Corpus preparation from end to end: five stages over ``documents``.

Quality rules drop bad documents; of near-duplicates one stays; byte strings that
repeat across documents are cut out; the rest is put in mixed order; texts are encoded
in that order, which the result's position column states.
All stages but the last return the columns of ``documents``; columns beyond the known
ones travel along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside.llm import bpe, jaccard_join, mixing, quality_rules, suffix_dedup
from bedside.llm.common import read_table, remove_written, written

KNOWN = ["doc_id", "text", "lang", "source", "n_chars"]


def _packed(docs: DataFrame) -> DataFrame:
    extra = [F.col(f"`{c}`") for c in docs.columns if c not in KNOWN]
    return docs.select(*KNOWN, F.struct(*extra).alias("extra")) if extra else docs.select(*KNOWN)


def _unpacked(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*(F.col(c) if c in KNOWN else F.col("extra").getField(c).alias(c) for c in columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return _unpacked(quality_rules.keep_good(_packed(docs), labels), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _unpacked(jaccard_join.keep_one(_packed(docs)), docs.columns)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _unpacked(suffix_dedup.deduplicated(_packed(docs)), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = _packed(docs)
    return _unpacked(mixing.in_mixed_order(mixing.mix(packed), packed.columns), docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, position, n_tokens and ids, sorted by position.

    Reading files again loses their order. A row's place depends on the rows alone, so it is found anew.
    """
    mixed = mixing.mix(_packed(docs))
    ordered = mixing.in_mixed_order(mixed, ["doc_id", "source", "position", "text"])
    made = bpe.encode(ordered, keep=["doc_id", "source", "position"])
    return made.select("doc_id", "source", "position", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeat_stage),
    ("mixing sources", mixing_stage),
    ("bpe encoding", encoding_stage),
]

#: Learned cutoffs, components and encodings are beyond SQL; a test compares with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, "stage")
            if before is not None:
                remove_written(before)
            before = docs
    return docs
