"""Years of two digits where a surgery runs into the next century."""

from pyspark.sql import functions as F

from bedside.functions import timebase as T
from bedside.plans import datasets as D

TIMES = {c: "AN_START_DATETIME" for c in ("HOSP_ADMSN_TIME", "IN_OR_DTTM")} | {c: "AN_STOP_DATETIME" for c in ("HOSP_DISCH_TIME", "OUT_OR_DTTM")}


def cohort(spark):
    spans = [("a", "12/31/99 23:00", "1/1/00 0:30"), ("b", "12/31/99 12:00", "1/3/00 0:30"), ("c", "5/1/20 10:00", "5/1/20 9:00")]
    s = spark.createDataFrame(spans, "LOG_ID string, AN_START_DATETIME string, AN_STOP_DATETIME string")
    s = s.withColumns({c: F.col(t) for c, t in TIMES.items()} | {c: F.lit("1") for c in D.SURGERIES.columns.values() if c != "LOG_ID"})
    crosswalk = s.select(F.lit("0" * 16).alias("PAT_ID"), "LOG_ID")
    files = spark.createDataFrame([(f"w/{'0' * 16}CB-2100-01-01-08-45-00-000Z.xml",)], "path string")
    return D.or_records(crosswalk, s, files)


def test_surgery_into_the_next_century(spark):
    assert [(r.log_id, r.an_stop_ms - r.an_start_ms, r.out_or_ms - r.in_or_ms, r.n_xml_files) for r in cohort(spark).collect()] == [("a", 5_400_000, 5_400_000, 1)]
    day = 86_400_000
    ends = spark.sql("SELECT 10L AS a, 5L AS b UNION ALL SELECT 10L, 10L UNION ALL SELECT 10L, NULL")
    assert sorted((r[0] for r in ends.select(T.next_century(F.col("a"), F.col("b"), "UTC")).collect()), key=str) == [10, 5, None]
    assert day == D.DAY


def test_demographics_of_a_surgery_into_the_next_century(spark):
    waves = spark.createDataFrame([("a", 1, 2), ("c", 1, 2)], "entity_id string, wave_start_ms long, wave_end_ms long")
    rows = D.demographics_file("or_records", cohort(spark), waves).collect()
    assert [(r.entity_id, r.an_stop_ms - r.an_start_ms, r.out_or_ms - r.in_or_ms) for r in rows] == [("a", 5_400_000, 5_400_000)]
