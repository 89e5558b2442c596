"""Severity scores and onset events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside.operators.asof import as_of, nearest
from bedside.operators.rangejoin import band_max
from bedside.operators.trajectory import part_summary, split_events
from bedside.schemas import HOUR_MS

# Variables of the score's inputs and components.
PAO2, CREATININE, BILIRUBIN, PLATELETS, GCS, MAP, NE_RATE, FIO2 = 14, 5, 6, 7, 108, 106, 200, 203
RESP, COAG, LIVER, CARDIO, CNS, RENAL, ONSET = 301, 302, 303, 304, 305, 306, 307
#: Score ladders: (bound, score), tried in order; "below" or "from" the bound.
BELOW = {PLATELETS: (COAG, ((20, 4), (50, 3), (100, 2), (150, 1))), GCS: (CNS, ((6, 4), (10, 3), (13, 2), (15, 1)))}
FROM = {BILIRUBIN: (LIVER, ((12, 4), (6, 3), (1.2, 2))), CREATININE: (RENAL, ((5, 4), (3.5, 3), (2, 2), (1.2, 1)))}
PF_LADDER = ((100, 4), (200, 3), (300, 2), (400, 1))
ROOM_AIR = 0.21


def ladder(value: Column, steps: tuple[tuple[float, int], ...], below: bool) -> Column:
    out = F.lit(0)
    for bound, score in reversed(steps):
        out = F.when(value < bound if below else value >= bound, score).otherwise(out)
    return out


def simple_scores(events: DataFrame, by: list[str]) -> DataFrame:
    """Components that one value decides: coagulation, liver, nerves, kidneys."""
    var, v = F.col("var_id"), F.col("value")
    target, score = F.lit(None).cast("int"), F.lit(None).cast("int")
    for ladders, below in ((BELOW, True), (FROM, False)):
        for source, (component, steps) in ladders.items():
            target = F.when(var == source, component).otherwise(target)
            score = F.when(var == source, ladder(v, steps, below)).otherwise(score)
    return events.where(var.isin(*BELOW, *FROM)).select(*by, "time_ms", target.alias("var_id"), score.cast("double").alias("value"))


def cardio_scores(events: DataFrame, by: list[str]) -> DataFrame:
    """Pressure and the largest vasopressor rate less than an hour away."""
    pressure = events.where(F.col("var_id") == MAP).select(*by, "time_ms", F.col("value").alias("map"))
    drugs = events.where(F.col("var_id") == NE_RATE).select(*by, "time_ms", F.col("value").alias("ne"))
    distinct = pressure.select(*by, "time_ms").distinct()
    near = band_max(distinct, drugs, by, "time_ms", "ne", HOUR_MS, [*by, "time_ms"])
    both = pressure.join(near, [*by, "time_ms"])
    score = F.when(F.col("ne") > 0.1, 4).when(F.col("ne") > 0, 3).when(F.col("map") < 70, 1).otherwise(0)
    return both.select(*by, "time_ms", F.lit(CARDIO).alias("var_id"), score.cast("double").alias("value"))


def resp_scores(events: DataFrame, by: list[str]) -> DataFrame:
    """Oxygen over inspired fraction; the nearest fraction less than four hours away, else room air."""
    oxygen = events.where(F.col("var_id") == PAO2).select(*by, "time_ms", F.col("value").alias("pao2"))
    fio2 = events.where(F.col("var_id") == FIO2).select(*by, "time_ms", F.col("value").alias("fio2"))
    both = nearest(oxygen, fio2, by, "time_ms", "fio2", 4 * HOUR_MS)
    part = F.coalesce("fio2", F.lit(ROOM_AIR))
    return both.where(part > 0).select(*by, "time_ms", F.lit(RESP).alias("var_id"), ladder(F.col("pao2") / part, PF_LADDER, True).cast("double").alias("value"))


def component_scores(events: DataFrame, by: list[str]) -> DataFrame:
    return simple_scores(events, by).unionByName(cardio_scores(events, by)).unionByName(resp_scores(events, by))


def task_events(scores: DataFrame, onset: DataFrame, axis: DataFrame, by: list[str]) -> DataFrame:
    """Scores and onset markers aligned to segments, apart from the canonical events (M11). ``onset``: onset_ms."""
    marks = onset.where("onset_ms IS NOT NULL").select(*by, F.col("onset_ms").alias("time_ms"), F.lit(ONSET).alias("var_id"), F.lit(1.0).alias("value"))
    return as_of(scores.unionByName(marks), axis.select(*by, "time_ms", "seg_idx"), by, "time_ms", ["seg_idx"]).where("seg_idx IS NOT NULL")


def task_trajectory(events: DataFrame, axis: DataFrame, episodes: DataFrame | None, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Task events in four parts, without pad, and their flags."""
    parted = split_events(events, axis, episodes, by)
    return parted, part_summary(parted, by, onset=ONSET)
