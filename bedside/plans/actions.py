"""Treatments from administration and output records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside.functions.clean import finite, fraction, mentions
from bedside.operators.dedup import first_per
from bedside.operators.mapping import registry_side

# Norepinephrine equivalents per unit of rate; vasopressin counts as a constant.
DOSE_FACTORS = {"norepinephrine": 1.0, "epinephrine": 1.0, "dopamine": 0.01, "phenylephrine": 0.1 / 80, "vasopressin": None}
VASOPRESSIN_DOSE = 0.1
RATE_VAR, INFUSION_VAR, BOLUS_VAR, FIO2_VAR, PEEP_VAR, VENT_VAR, URINE_VAR = 200, 201, 202, 203, 204, 205, 206
# Ranges of what is kept.
MOST_INFUSION, MOST_BOLUS = 2000, 5000
RANGES = {FIO2_VAR: (0.21, 1.0), PEEP_VAR: (0, 30), URINE_VAR: (0, 2500)}


def active(records: DataFrame, status: str = "status") -> DataFrame:
    """Records that weren't rewritten (F10); a null status is in neither branch."""
    return records.where(F.col(status) != "Rewritten")


def vasopressor_rate(records: DataFrame, doses: DataFrame, by: list[str], start: str) -> DataFrame:
    """Sum of concurrent drips in norepinephrine equivalents (X17, A4). ``doses``: drug, factor (null: constant)."""
    rate = F.when(F.col("factor").isNull(), F.lit(VASOPRESSIN_DOSE)).otherwise(F.col("rate") * F.col("factor"))
    rows = records.where("rate > 0").join(registry_side(doses), "drug").withColumn("_ne", rate)
    return rows.groupBy(*by, start).agg(F.sum("_ne").alias("value")).withColumn("var_id", F.lit(RATE_VAR))


def fluids(records: DataFrame, category: str = "category", word: str = "bolus") -> DataFrame:
    """Bolus amounts and infusion rates (M7); both need an amount above 0."""
    is_bolus = mentions(F.col(category), word)
    rest = [c for c in records.columns if c not in ("amount", "rate")]
    given = records.where((F.col("amount") > 0) & is_bolus.isNotNull())
    bolus = is_bolus & (F.col("amount") <= MOST_BOLUS)
    infusion = ~is_bolus & (F.col("rate") > 0) & (F.col("rate") <= MOST_INFUSION)
    var, value = F.when(is_bolus, BOLUS_VAR).otherwise(INFUSION_VAR), F.when(is_bolus, F.col("amount")).otherwise(F.col("rate"))
    return given.where(bolus | infusion).select(*rest, var.alias("var_id"), value.alias("value"))


def ventilation(events: DataFrame, by: list[str]) -> DataFrame:
    """Ventilated where FiO2 is above room air or PEEP above 0 (M8)."""
    v = F.col("value")
    on = ((F.col("var_id") == FIO2_VAR) & (v > 0.21)) | ((F.col("var_id") == PEEP_VAR) & (v > 0))
    return events.where(on).select(*by, "time_ms").distinct().withColumns({"var_id": F.lit(VENT_VAR), "value": F.lit(1.0)})


def charted(events: DataFrame, by: list[str]) -> DataFrame:
    """FiO2 as a fraction, PEEP and urine output inside their ranges (M9, X16); the first of a time, then the least, stays."""
    value = F.when(F.col("var_id") == FIO2_VAR, fraction(F.col("value"))).otherwise(F.col("value"))
    inside = F.lit(False)
    for var, (low, high) in RANGES.items():
        inside = inside | ((F.col("var_id") == var) & F.col("value").between(low, high))
    return first_per(events.withColumn("value", value).where(finite(F.col("value")) & inside), [*by, "time_ms", "var_id"], ["value"])
