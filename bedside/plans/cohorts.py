"""Cohorts: entities with bounds, cases and controls, stays matched to recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedside.functions.clean import bounded_end, valid_interval
from bedside.operators.aggregates import position


def build_cohort(rows: DataFrame, entity: str, patient: str, start: str, end: str, least_ms: int = 0, most_ms: int | None = None, strict: bool = False) -> DataFrame:
    """One row per entity with valid bounds (M22, F12, F13, U4): the earliest start, the latest end."""
    ok = rows.where(valid_interval(F.col(start), F.col(end), strict))
    one = ok.groupBy(entity).agg(F.min(patient).alias("patient_id"), F.min(start).alias("start_ms"), F.max(end).alias("end_ms"), F.count("*").alias("n_rows"))
    one = one.withColumnRenamed(entity, "entity_id")
    if most_ms is not None:
        one = one.withColumn("end_ms", bounded_end(F.col("start_ms"), F.col("end_ms"), most_ms))
    return one.where(F.col("end_ms") - F.col("start_ms") >= least_ms)


def onset_cohort(cohort: DataFrame, onset: DataFrame, key: str) -> DataFrame:
    """Cases and controls with the onset's place against the recording."""
    both = cohort.join(onset, key, "left")
    return both.withColumns({"is_case": F.col("onset_ms").isNotNull(), "position": position(F.col("onset_ms"), F.col("start_ms"), F.col("end_ms"))})


def patient_label(entities: DataFrame, patient: str, is_case: str) -> DataFrame:
    """A patient is a case if any entity is one."""
    return entities.groupBy(patient).agg(F.max(F.col(is_case).cast("int")).alias("is_case"), F.count("*").alias("n_entities"))


def with_candidates(left: DataFrame, right: DataFrame, on: list[str], key: str) -> DataFrame:
    """Left join with the number of candidates of each entity."""
    return left.join(right, on, "left").withColumn("n_candidates", F.count("*").over(Window.partitionBy(key)))


def transfer_bounds(log: DataFrame, key: str) -> DataFrame:
    """Episode bounds from a transfer log (M32): inside the recording; a stop before its start is ignored."""
    stop = F.when(F.col("wave_stop") < F.col("wave_start"), F.col("bed_out")).otherwise(F.col("wave_stop"))
    rows = log.withColumns({"_a": F.greatest("bed_in", "wave_start"), "_b": F.least("bed_out", stop)})
    return rows.groupBy(key).agg(F.min("_a").alias("ep_start"), F.max("_b").alias("ep_end"))


def summary(cohort: DataFrame) -> DataFrame:
    """Entities, patients, hours: total, median."""
    hours = (F.col("end_ms") - F.col("start_ms")) / 3_600_000
    return cohort.agg(F.count("*").alias("n"), F.count_distinct("patient_id").alias("n_patients"), F.sum(hours).alias("hours"), F.median(hours).alias("median_hours"))


def encounter_spans(records: DataFrame, key: str, start: str, end: str, record: str) -> DataFrame:
    """Records of each encounter with their span: count, first and last bound, recorded and spanned time (A2, A3).

    The record at the first start stands for the encounter; of equal starts the least one.
    """
    length = F.col(end) - F.col(start)
    out = records.groupBy(key).agg(F.count_distinct(record).alias("n_records"), F.min(start).alias("start_ms"), F.max(end).alias("end_ms"), F.sum(length).alias("recorded_ms"), F.min_by(record, F.struct(start, record)).alias("first_record"), F.sort_array(F.collect_set(record)).alias("records"))
    return out.withColumn("span_ms", F.col("end_ms") - F.col("start_ms"))


def stay_map(stays: DataFrame, admissions: DataFrame, labelled: DataFrame, stay: str, admission: str) -> DataFrame:
    """Stays with their admission's columns, cut down to labelled stays."""
    return stays.join(labelled.select(stay).distinct(), stay, "left_semi").join(admissions, admission)
