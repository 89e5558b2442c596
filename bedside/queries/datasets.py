"""Queries on the cohorts and demographics of the seven kinds of export: the given tables in each export's layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from bedside.plans import datasets as D
from bedside.queries.common import DAY, query, table

HOUR = 3_600_000
ORDER = "CAST(o_orderkey AS VARCHAR)"
#: Hours and days that vary over rows, so that local times and intervals do.
WALL = "(o_orderdate + to_hours(CAST(4 + o_orderkey % 20 AS BIGINT)))"


def ms(at: str, zone: str | None = None) -> str:
    """Milliseconds; of wall times that occur twice the earlier one, of those that a clock change skips null."""
    if not zone:
        return f"epoch_us({at}) // 1000"
    utc = f"timezone('{zone}', {at})"
    return f"CASE WHEN timezone('{zone}', {utc} - to_hours(1)) = {at} THEN epoch_us({utc} - to_hours(1)) // 1000 WHEN timezone('{zone}', {utc}) = {at} THEN epoch_us({utc}) // 1000 END"


def moved(column: str, hours):
    """A date of the tables plus hours."""
    return F.col(column).cast("timestamp_ntz") + F.make_dt_interval(hours=hours.cast("int"))


def text(at, pattern: str):
    return F.date_format(at, pattern)


def orders(spark, sf):
    return table(spark, sf, "orders").withColumns({"key": F.col("o_orderkey").cast("string"), "wall": moved("o_orderdate", 4 + F.col("o_orderkey") % 20)})


def waves(spark, sf):
    """Orders that aren't pending have a written recording."""
    at = F.unix_millis(F.to_utc_timestamp(F.col("o_orderdate").cast("timestamp"), "UTC"))
    return table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("entity_id"), at.alias("wave_start_ms"), (at + 5 * DAY).alias("wave_end_ms"))


WAVES = f"waves AS (SELECT {ORDER} AS entity_id, {ms('o_orderdate')} AS wave_start_ms, {ms('o_orderdate')} + {5 * DAY} AS wave_end_ms FROM orders WHERE o_orderstatus <> 'P')"


def icu(spark, sf):
    o = orders(spark, sf)
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    tasks = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("encounter_nbr"),
        text(ship, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("valid_start"),
        text(moved("l_shipdate", F.col("l_quantity")), "yyyy-MM-dd'T'HH:mm:ss").alias("valid_end"),
        F.col("l_quantity").cast("string").alias("valid_duration_hour"),
        F.col("l_discount").cast("string").alias("valid_ratio"),
        F.col("l_returnflag").alias("type"),
        F.concat(F.lit("r"), "l_suppkey").alias("wfdb_record"),
        F.when(F.col("l_returnflag") == "R", text(ship, "yyyy-MM-dd'T'HH:mm:ss")).alias("sepsis_time_zero_dttm"),
    )
    start = F.col("o_orderdate").cast("timestamp_ntz")
    recordings = o.select(
        F.col("key").alias("encounter_nbr"),
        F.col("o_custkey").cast("string").alias("empi_nbr"),
        F.concat(F.lit("w"), "key").alias("wfdb_record"),
        F.concat(text(start, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("wfdb_start"),
        F.concat(text(moved("o_orderdate", 4 + F.col("o_orderkey") % 20), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("wfdb_end"),
    )
    encounters = o.where("o_orderstatus <> 'P'").select(
        F.col("key").alias("ENCOUNTER_NBR"),
        F.col("o_custkey").cast("string").alias("PAT_ID"),
        (20 + F.col("o_custkey") % 60).cast("string").alias("AGE"),
        text(F.col("wall"), "MM/dd/yyyy HH:mm:ss").alias("HOSPITAL_ADMISSION_DATE_TIME"),
        text(F.col("wall") + F.expr("INTERVAL 36 HOURS"), "MM/dd/yyyy HH:mm:ss").alias("HOSPITAL_DISCHARGE_DATE_TIME"),
        F.col("o_orderpriority").alias("DIAGNOSIS_ICD10_CD"),
        F.lower("o_orderpriority").alias("DIAGNOSIS_ICD10_DESC"),
        F.col("o_orderstatus").alias("ENCOUNTER_TYPE"),
        F.lit("x").alias("INSURANCE_STATUS"),
        F.lit("site").alias("ENTITY_HEALTHCARE_NM"),
    )
    return D.icu_lists(tasks, recordings, encounters)


NEW_YORK, PACIFIC = "America/New_York", "America/Los_Angeles"
ICU = f"""t AS (SELECT l_orderkey AS encounter_nbr, {ms('l_shipdate')} AS a, {ms('l_shipdate')} + CAST(l_quantity AS BIGINT) * {HOUR} AS b, l_quantity AS q, l_discount AS d, l_returnflag AS type, 'r' || l_suppkey AS rec FROM lineitem),
firsts AS (SELECT encounter_nbr, type, CASE WHEN type = 'R' THEN a END AS sepsis_time_zero_ms FROM (SELECT *, row_number() OVER (PARTITION BY encounter_nbr ORDER BY a, rec, type) AS rn FROM t) WHERE rn = 1),
tasks AS (SELECT encounter_nbr, min(a) AS valid_start_ms, max(b) AS valid_end_ms, sum(q) AS valid_duration_hour_sum, round(avg(d), 6) AS valid_ratio_mean, list_sort(list(DISTINCT rec)) AS wfdb_records FROM t GROUP BY 1),
cohort AS (SELECT o_custkey || '_' || o_orderkey AS entity_id, o_custkey AS empi_nbr, encounter_nbr, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS pat_id, type,
  {ms('o_orderdate')} AS wave_start_ms, {ms(WALL)} AS wave_end_ms, (4 + o_orderkey % 20) / 24.0 AS wave_duration_days, valid_start_ms, valid_end_ms, (valid_end_ms - valid_start_ms) / {HOUR}.0 AS valid_duration_hour_max,
  valid_duration_hour_sum, valid_ratio_mean, sepsis_time_zero_ms, CASE WHEN o_orderstatus <> 'P' THEN {ms(WALL, NEW_YORK)} END AS admit_ms, CASE WHEN o_orderstatus <> 'P' THEN {ms(f'({WALL} + to_hours(36))', NEW_YORK)} END AS discharge_ms,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(20 + o_custkey % 60 AS INTEGER) END AS age, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS admit_dx_icd10, wfdb_records, o_orderstatus
  FROM tasks JOIN firsts USING (encounter_nbr) JOIN orders ON o_orderkey = encounter_nbr)"""
ICU_COLUMNS = "entity_id, empi_nbr, encounter_nbr, pat_id, type, wave_start_ms, wave_end_ms, round(wave_duration_days, 6) AS wave_duration_days, valid_start_ms, valid_end_ms, round(valid_duration_hour_max, 6) AS valid_duration_hour_max, valid_duration_hour_sum, valid_ratio_mean, sepsis_time_zero_ms, admit_ms, discharge_ms, age, admit_dx_icd10, array_to_string(wfdb_records, ' ') AS wfdb_records"


@query(f"WITH {ICU} SELECT {ICU_COLUMNS} FROM cohort")
def cohort_icu_lists(spark, sf):
    c = icu(spark, sf)
    names = "entity_id empi_nbr encounter_nbr pat_id type wave_start_ms wave_end_ms wave_duration_days valid_start_ms valid_end_ms valid_duration_hour_max valid_duration_hour_sum valid_ratio_mean sepsis_time_zero_ms admit_ms discharge_ms age admit_dx_icd10 wfdb_records".split()
    rounded = {n: F.round(n, 6) for n in ("wave_duration_days", "valid_duration_hour_max", "valid_ratio_mean")}
    return c.withColumns(rounded).withColumn("wfdb_records", F.array_join("wfdb_records", " ")).select(*names)


@query(f"""WITH {ICU} SELECT entity_id, empi_nbr, encounter_nbr, pat_id, CASE WHEN pat_id IS NOT NULL THEN c_mktsegment END AS gender, CASE WHEN pat_id IS NOT NULL THEN '1960-01-02' END AS dob_iso, age AS age_years,
CASE WHEN pat_id IS NOT NULL THEN 'race' END AS race, CASE WHEN pat_id IS NOT NULL THEN c_name END AS ethnicity, CASE WHEN pat_id IS NOT NULL THEN 'x' END AS insurance, admit_ms AS admit_utc_ms, discharge_ms AS discharge_utc_ms,
round((discharge_ms - admit_ms) / {DAY}.0, 3) AS los_days, admit_dx_icd10, lower(admit_dx_icd10) AS admit_dx_desc, CASE WHEN pat_id IS NOT NULL THEN 'site' END AS entity_healthcare_nm,
CASE WHEN pat_id IS NULL OR c_acctbal >= 5000 THEN NULL WHEN c_acctbal < 0 THEN {ms("TIMESTAMP '2001-07-04 00:00:00'", NEW_YORK)} ELSE {ms("TIMESTAMP '2002-12-05 06:07:08'", NEW_YORK)} END AS death_date_utc_ms,
wave_start_ms, wave_end_ms, type FROM cohort LEFT JOIN customer ON c_custkey = empi_nbr""")
def demographics_icu(spark, sf):
    death = F.when(F.col("c_acctbal") < 0, "07/04/2001").when(F.col("c_acctbal") < 5000, "2002-12-05 06:07:08").otherwise("unknown")
    people = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("PAT_ID"), F.col("c_mktsegment").alias("GENDER"), F.lit("1960-01-02").alias("DOB"), F.lit("race").alias("RACE"), F.col("c_name").alias("ETHNICITY"), death.alias("DEATH_DATE"))
    return D.demographics_file("icu", D.icu_people(icu(spark, sf), people))


def arrest(spark, sf):
    o = orders(spark, sf)
    wall = text(F.col("wall"), "yyyy-MM-dd HH:mm:ss")
    labels = o.select(
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" DE"), "o_custkey")).otherwise(F.col("o_custkey").cast("string")).alias("Patient_ID_GE"),
        F.concat("key", F.lit(" ")).alias("WaveCycleUID"),
        F.lower("o_orderstatus").alias("Wynton_folder"),
        F.lit("U1").alias("UnitBed"),
        text(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("ValidStartTime"),
        F.when(F.col("o_orderpriority") == "5-LOW", "2000").otherwise(wall).alias("ValidStopTime"),
        F.when(F.col("o_orderstatus") == "O", wall).otherwise(" -1 ").alias("EventTime"),
    )
    offsets = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Patient_ID_GE"),
        F.explode(F.array(F.lit("f"), F.lit("f "), F.lit("o"))).alias("Wynton_folder"),
        F.col("c_custkey").cast("string").alias("Encounter_ID"),
        F.col("c_name").alias("Patient_ID"),
        F.lit("2001-02-03 04:05:06").alias("Encounter_Start_time"),
        F.col("c_nationkey").cast("string").alias("Encounter_LOS"),
        F.lit("3").alias("offset"),
        (F.col("c_nationkey") + 1).cast("string").alias("offset_GE"),
    )
    return D.arrest_monitors(labels, offsets)


ARREST = f"""l AS (SELECT *, CAST(o_custkey AS VARCHAR) AS pid, lower(o_orderstatus) AS folder, {ms('o_orderdate')} AS a, CASE WHEN o_orderpriority = '5-LOW' THEN {ms("TIMESTAMP '2000-01-01'")} ELSE {ms(WALL)} END AS b FROM orders),
off AS (SELECT CAST(c_custkey AS VARCHAR) AS pid, trim(unnest(['f', 'f ', 'o'])) AS folder, c_custkey AS encounter_id, c_name AS patient_id, CAST(c_nationkey AS BIGINT) AS los, {ms("TIMESTAMP '2001-02-03 04:05:06'")} - (c_nationkey - 2) * {DAY} AS adm FROM customer),
cohort AS (SELECT l.pid || '_' || o_orderkey AS entity_id, l.pid AS patient_id_ge, 'U1-' || CASE WHEN o_orderstatus = 'F' THEN 'DE' ELSE '' END || l.pid AS bed_subdir, a AS episode_start_ms, b AS episode_end_ms, (b - a) / 1000.0 AS episode_duration_sec,
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS has_ca, encounter_id, patient_id, los AS encounter_los_days, adm AS admission_start_ms, adm + los * {DAY} AS admission_end_ms, count(*) OVER (PARTITION BY o_orderkey) AS n_candidate_encounters
  FROM l LEFT JOIN off ON l.pid = off.pid AND l.folder = off.folder WHERE b > a)"""
ARREST_COLUMNS = "entity_id patient_id_ge bed_subdir episode_start_ms episode_end_ms episode_duration_sec has_ca encounter_id patient_id encounter_los_days admission_start_ms admission_end_ms n_candidate_encounters".split()


@query(f"WITH {ARREST} SELECT {', '.join(ARREST_COLUMNS)} FROM cohort")
def cohort_arrest_monitors(spark, sf):
    return arrest(spark, sf).select(*ARREST_COLUMNS)


@query(f"""WITH {ARREST} SELECT DISTINCT entity_id, patient_id_ge, encounter_id, CAST(30 + encounter_id % 9 AS VARCHAR) AS age_years, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS ethnicity, CAST(NULL AS VARCHAR) AS insurance, c_mktsegment AS admission_type,
encounter_los_days AS los_days, admission_start_ms, admission_end_ms, episode_start_ms AS wave_start_ms, episode_end_ms AS wave_end_ms, has_ca FROM cohort LEFT JOIN customer ON c_custkey = encounter_id""")
def demographics_arrest(spark, sf):
    c = arrest(spark, sf).withColumns({"wave_start_ms": F.col("episode_start_ms"), "wave_end_ms": F.col("episode_end_ms")})
    seen = table(spark, sf, "customer").select(F.col("c_custkey").alias("encounter_id"), (30 + F.col("c_custkey") % 9).cast("string").alias("age"), F.col("c_mktsegment").alias("admit_type"))
    return D.demographics_file("arrest", c.join(seen, "encounter_id", "left"))


def visits(spark, sf):
    kind = F.element_at(F.array(F.lit("Pleth"), F.lit("II"), F.lit("Resp")), (1 + F.col("l_linenumber") % 3).cast("int"))
    w = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("CSN"), kind.alias("Type")).agg(F.count("*").cast("string").alias("Segments"), F.sum("l_quantity").cast("string").alias("Duration"))
    o = orders(spark, sf)
    start = text(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    wall = text(F.col("wall"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    blank = {c: F.lit(c) for c in "Visits Race Ethnicity Means_of_arrival Triage_acuity ED_dispo Admit_service Dx_ICD10 Dx_name Payor_class".split()}
    v = o.withColumns(
        blank
        | {
            "CSN": F.col("key"),
            "MRN": F.col("o_custkey").cast("string"),
            "Visit_no": F.lit("1"),
            "Age": F.when(F.col("o_orderstatus") == "F", "90+").otherwise("61"),
            "Gender": F.col("o_orderpriority"),
            "CC": F.col("o_orderpriority"),
            "ED_LOS": F.col("o_totalprice").cast("string"),
            "Hosp_LOS": F.lit(""),
            "Arrival_time": start,
            "Roomed_time": F.lit("soon"),
            "Dispo_time": wall,
            "Admit_time": F.lit(None).cast("string"),
            "Departure_time": F.when(F.col("o_orderpriority") == "5-LOW", "1980-01-01T00:00:00Z").otherwise(wall),
        }
    )
    return D.ed_visits(w, v)


VISITS = f"""w AS (SELECT l_orderkey, count(*) FILTER (l_linenumber % 3 = 0) AS p, count(*) FILTER (l_linenumber % 3 = 1) AS i, count(*) FILTER (l_linenumber % 3 = 2) AS r, coalesce(sum(l_quantity) FILTER (l_linenumber % 3 = 0), 0) AS dp, coalesce(sum(l_quantity) FILTER (l_linenumber % 3 = 2), 0) AS dr FROM lineitem GROUP BY 1),
cohort AS (SELECT {ORDER} AS entity_id, o_orderkey AS csn, o_custkey AS mrn, {ms('o_orderdate')} AS arrival_ms, CAST(NULL AS BIGINT) AS roomed_ms, {ms(WALL)} AS dispo_ms, CAST(NULL AS BIGINT) AS admit_ms, {ms(WALL)} AS departure_ms, o_totalprice AS ed_los_hours, CAST(NULL AS DOUBLE) AS hosp_los_days,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 61 END AS age, o_orderpriority AS gender, CAST(p AS INTEGER) AS n_pleth_seg, CAST(i AS INTEGER) AS n_ii_seg, CAST(r AS INTEGER) AS n_resp_seg, dp AS duration_pleth_s, dr AS duration_resp_s
  FROM orders JOIN w ON l_orderkey = o_orderkey WHERE p >= 1 AND o_orderpriority <> '5-LOW')"""
VISIT_COLUMNS = "entity_id csn mrn arrival_ms roomed_ms dispo_ms admit_ms departure_ms ed_los_hours hosp_los_days age gender n_pleth_seg n_ii_seg n_resp_seg duration_pleth_s duration_resp_s".split()


@query(f"WITH {VISITS} SELECT {', '.join(VISIT_COLUMNS)} FROM cohort")
def cohort_ed_visits(spark, sf):
    return visits(spark, sf).select(*VISIT_COLUMNS)


@query(f"WITH {VISITS}, {WAVES} SELECT entity_id, csn, mrn, '1' AS visit_no, 'Dx_name' AS dx_name, gender AS chief_complaint, age, arrival_ms AS arrival_utc_ms, departure_ms AS departure_utc_ms, dispo_ms AS dispo_utc_ms, round(ed_los_hours, 2) AS ed_los_hours, wave_start_ms, wave_end_ms FROM cohort JOIN waves USING (entity_id)")
def demographics_visits(spark, sf):
    d = D.demographics_file("visits", visits(spark, sf), waves(spark, sf))
    return d.withColumn("ed_los_hours", F.round("ed_los_hours", 2)).select("entity_id", "csn", "mrn", "visit_no", "dx_name", "chief_complaint", "age", "arrival_utc_ms", "departure_utc_ms", "dispo_utc_ms", "ed_los_hours", "wave_start_ms", "wave_end_ms")


def operations(spark, sf):
    o = orders(spark, sf)
    wall, end = text(F.col("wall"), "M/d/yy H:mm"), text(F.col("wall") + F.expr("INTERVAL 3 HOURS"), "M/d/yy H:mm")
    patients = o.select(
        F.col("key").alias("PID"), F.lit("55").alias("Age"), F.col("o_orderstatus").alias("Gender"), (F.col("o_totalprice") / 1000).cast("string").alias("Ht"), F.lit("n/a").alias("Wt"), F.col("o_orderpriority").alias("Procedure"),
        wall.alias("OR_start"), F.when(F.col("o_orderpriority") == "5-LOW", "1/2/03 4:05").otherwise(end).alias("OR_end"), F.lit("").alias("Surgery_start"), end.alias("Surgery_end"),
    )
    files = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("pid"), F.concat_ws("/", "l_orderkey", "l_partkey").alias("path"))
    return D.or_monitors(patients, files)


# Years of two digits are of this century.
CENTURY = f"({WALL} + CASE WHEN year({WALL}) < 2000 THEN to_years(100) ELSE to_years(0) END)"
CENTURY_END = f"({WALL} + to_hours(3) + CASE WHEN year({WALL} + to_hours(3)) < 2000 THEN to_years(100) ELSE to_years(0) END)"
OPERATIONS = f"""n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
both_ends AS (SELECT *, {ms(CENTURY, PACIFIC)} AS a, {ms(CENTURY_END, PACIFIC)} AS e, CASE WHEN o_orderpriority = '5-LOW' THEN {ms("TIMESTAMP '2003-01-02 04:05:00'", PACIFIC)} ELSE {ms(CENTURY_END, PACIFIC)} END AS b FROM orders JOIN n ON l_orderkey = o_orderkey),
cohort AS (SELECT {ORDER} AS entity_id, {ORDER} AS pid, a AS or_start_ms, b AS or_end_ms, CAST(NULL AS BIGINT) AS surgery_start_ms, e AS surgery_end_ms, n AS n_xml_files, 55 AS age, o_orderstatus AS gender, round(o_totalprice / 1000, 1) AS height_cm, CAST(NULL AS DOUBLE) AS weight_kg, o_orderpriority AS procedure FROM both_ends WHERE b >= a)"""
OPERATION_COLUMNS = "entity_id pid or_start_ms or_end_ms surgery_start_ms surgery_end_ms n_xml_files age gender procedure".split()


@query(f"WITH {OPERATIONS} SELECT {', '.join(OPERATION_COLUMNS)} FROM cohort")
def cohort_or_monitors(spark, sf):
    return operations(spark, sf).select(*OPERATION_COLUMNS)


@query(f"WITH {OPERATIONS}, {WAVES} SELECT {', '.join(OPERATION_COLUMNS)}, weight_kg, wave_start_ms, wave_end_ms FROM cohort JOIN waves USING (entity_id)")
def demographics_or_monitors(spark, sf):
    return D.demographics_file("or_monitors", operations(spark, sf), waves(spark, sf)).drop("height_cm")


def records(spark, sf):
    o = orders(spark, sf)
    crosswalk = o.select(F.lpad(F.col("o_custkey").cast("string"), 16, "0").alias("PAT_ID"), F.col("key").alias("LOG_ID"))
    start = text(F.col("wall"), "M/d/yy H:mm")
    stop = text(F.col("wall") + F.expr("INTERVAL 90 MINUTES"), "M/d/yy H:mm")
    names = {"HEIGHT": F.lit("170.25"), "WEIGHT": F.lit("x"), "LOS": F.col("o_totalprice").cast("string"), "SEX": F.col("o_orderstatus"), "MRN": F.col("o_custkey").cast("string")}
    fixed = {c: F.lit(c) for c in "ICU_ADMIN_FLAG BIRTH_DATE PRIMARY_ANES_TYPE_NM ASA_RATING PATIENT_CLASS_NM PRIMARY_PROCEDURE_NM DISCH_DISP".split()}
    times = {c: start for c in ("HOSP_ADMSN_TIME", "IN_OR_DTTM", "AN_START_DATETIME")} | {c: stop for c in ("HOSP_DISCH_TIME", "OUT_OR_DTTM")}
    surgeries = o.withColumns(names | fixed | times | {"LOG_ID": F.col("key"), "AN_STOP_DATETIME": F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string")).otherwise(stop)})
    # A file of each order of the patient, at the surgery's wall time taken as UTC, plus seven to ten hours.
    late = text(F.col("wall") + F.expr("INTERVAL 100 YEARS") + F.make_dt_interval(hours=(7 + F.col("o_orderkey") % 4).cast("int")), "yyyy-MM-dd-HH-mm-ss-SSS")
    late = F.when(F.year("wall") < 2000, late).otherwise(text(F.col("wall") + F.make_dt_interval(hours=(7 + F.col("o_orderkey") % 4).cast("int")), "yyyy-MM-dd-HH-mm-ss-SSS"))
    files = o.select(F.concat(F.lit("w/"), F.lpad(F.col("o_custkey").cast("string"), 16, "0"), F.lit("CB-"), late, F.lit("Z.xml")).alias("path"))
    return D.or_records(crosswalk, surgeries, files)


RECORDS = f"""s AS (SELECT *, {ms(CENTURY, PACIFIC)} AS a, {ms(f"({CENTURY} + to_minutes(90))", PACIFIC)} AS b, {ms(CENTURY)} + (7 + o_orderkey % 4) * {HOUR} AS f FROM orders),
per AS (SELECT x.o_orderkey, count(DISTINCT y.f) AS n_xml_files, min(y.f) AS xml_ms_min, max(y.f) AS xml_ms_max FROM s x JOIN s y ON x.o_custkey = y.o_custkey AND y.f BETWEEN x.a - {HOUR} AND x.b + {HOUR} WHERE x.o_orderpriority <> '5-LOW' GROUP BY 1),
cohort AS (SELECT {ORDER} AS entity_id, {ORDER} AS log_id, CAST(o_custkey AS VARCHAR) AS mrn, o_orderstatus AS sex, a AS an_start_ms, b AS an_stop_ms, n_xml_files, xml_ms_min, xml_ms_max FROM s JOIN per USING (o_orderkey))"""
RECORD_COLUMNS = "entity_id log_id mrn sex an_start_ms an_stop_ms n_xml_files xml_ms_min xml_ms_max".split()


@query(f"WITH {RECORDS} SELECT {', '.join(RECORD_COLUMNS)} FROM cohort")
def cohort_or_records(spark, sf):
    return records(spark, sf).select(*RECORD_COLUMNS)


@query(f"WITH {RECORDS}, {WAVES} SELECT entity_id, log_id, mrn, sex, an_start_ms, an_stop_ms, n_xml_files, CAST(170.2 AS DOUBLE) AS height_cm, CAST(NULL AS DOUBLE) AS weight_kg, 'ASA_RATING' AS asa_rating, wave_start_ms, wave_end_ms FROM cohort JOIN waves USING (entity_id)")
def demographics_or_records(spark, sf):
    d = D.demographics_file("or_records", records(spark, sf), waves(spark, sf))
    return d.select("entity_id", "log_id", "mrn", "sex", "an_start_ms", "an_stop_ms", "n_xml_files", "height_cm", "weight_kg", "asa_rating", "wave_start_ms", "wave_end_ms")


def cases(spark, sf):
    o = orders(spark, sf)
    numbers = {"caseid": F.col("key"), "subjectid": F.col("o_custkey").cast("string"), "age": F.lit("0.5"), "height": F.col("o_totalprice").cast("string"), "weight": F.lit(""), "bmi": F.lit("21.456"), "asa": F.lit("2"), "icu_days": F.lit("0"), "death_inhosp": F.lit("0")}
    seconds = {c: F.lit("0") for c in ("casestart", "caseend", "opstart", "opend", "adm", "dis", "anestart")} | {"aneend": (F.col("o_orderkey") % 5 * 600).cast("string")}
    texts = {c: F.col("o_orderpriority") for c in ("sex", "emop", "department", "optype", "dx", "opname", "approach", "position", "ane_type")}
    files = o.where("o_orderstatus <> 'P'").select(F.concat(F.lit("v/"), F.lpad("key", F.greatest(F.length("key"), F.lit(4)), F.lit("0")), F.lit(".vital")).alias("path"))
    return D.surgical_cases(o.withColumns(numbers | seconds | texts), files, "v")


CASES = """c AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(4, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS entity_id, o_orderkey AS caseid, o_custkey AS subjectid, CAST(o_orderkey % 5 * 600 AS DOUBLE) AS aneend_s, o_totalprice AS height_cm, o_orderpriority AS sex, o_orderstatus FROM orders),
cohort AS (SELECT * EXCLUDE (rn) FROM (SELECT c.*, row_number() OVER (PARTITION BY entity_id ORDER BY aneend_s, subjectid) AS rn FROM c WHERE aneend_s > 0 AND entity_id IN (SELECT entity_id FROM c WHERE o_orderstatus <> 'P')) WHERE rn = 1)"""


@query(f"WITH {CASES} SELECT entity_id, subjectid, aneend_s, sex, 'v/' || entity_id || '.vital' AS vital_file_path FROM cohort")
def cohort_surgical_cases(spark, sf):
    return cases(spark, sf).select("entity_id", "subjectid", "aneend_s", "sex", "vital_file_path")


@query(f"WITH {CASES}, {WAVES} SELECT entity_id, subjectid, aneend_s, sex, CAST(0.5 AS DOUBLE) AS age, CAST(21.46 AS DOUBLE) AS bmi, 2 AS asa, CAST(NULL AS DOUBLE) AS weight_kg, wave_start_ms, wave_end_ms FROM cohort JOIN waves USING (entity_id)")
def demographics_cases(spark, sf):
    d = D.demographics_file("cases", cases(spark, sf), waves(spark, sf))
    return d.select("entity_id", "subjectid", "aneend_s", "sex", "age", "bmi", "asa", "weight_kg", "wave_start_ms", "wave_end_ms")


def matched(spark, sf):
    c = table(spark, sf, "customer")
    inventory = c.select(
        F.concat_ws("_", "c_custkey", "c_nationkey").alias("patient_id"), F.col("c_custkey").alias("subject_id"), (F.col("c_mktsegment") != "BUILDING").alias("has_pleth"), F.lit(True).alias("has_ii"),
        F.col("c_acctbal").alias("pleth_duration_sec"), (F.col("c_acctbal") + 100).alias("ii_duration_sec"),
    )
    items = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    events = items.select(F.col("o_custkey").alias("subject_id"), F.col("l_linenumber").alias("var_id"), "l_returnflag")
    return D.matched_recordings(inventory, events.where("l_returnflag = 'A'"), events.where("l_returnflag = 'R'"))


@query("""WITH e AS (SELECT o_custkey AS subject_id, l_linenumber AS v, l_returnflag AS f FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag IN ('A', 'R')),
n AS (SELECT subject_id, count(*) FILTER (f = 'A') AS n_lab_events, count(*) FILTER (f = 'R') AS n_vital_events, count(DISTINCT v) FILTER (f = 'A') AS n_lab_variables, count(DISTINCT v) FILTER (f = 'R') AS n_vital_variables, count(DISTINCT v) AS n_vars, count(*) AS n_total_ehr FROM e GROUP BY 1)
SELECT c_custkey || '_' || c_nationkey AS patient_id, n.* FROM customer JOIN n ON subject_id = c_custkey WHERE c_mktsegment <> 'BUILDING' AND c_acctbal >= 300""")
def cohort_matched_recordings(spark, sf):
    return matched(spark, sf).select("patient_id", "subject_id", "n_lab_events", "n_vital_events", "n_lab_variables", "n_vital_variables", "n_vars", "n_total_ehr")


@query("""SELECT c_custkey || '_' || c_nationkey AS patient_id, c_custkey AS subject_id, CAST(c_nationkey AS BIGINT) AS hadm_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END AS gender,
CASE WHEN n_name IS NULL THEN NULL ELSE least(round(greatest(date_diff('day', DATE '1920-02-29' + CAST(c_custkey % 20000 AS INTEGER), DATE '1990-06-01') / 365.25, 0), 2), 89) END AS age_years,
coalesce(n_name, '') AS ethnicity, '' AS insurance, 'EMERGENCY' AS admission_type, CASE WHEN c_acctbal < 0 THEN '' ELSE 'D1' END AS icd9_primary, CAST(c_nationkey % 2 AS INTEGER) AS died_in_hospital FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def demographics_matched(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    subject, stay = F.col("c_custkey").alias("SUBJECT_ID"), F.col("c_nationkey").cast("bigint").alias("HADM_ID")
    born = F.date_add(F.lit("1920-02-29").cast("date"), (F.col("c_custkey") % 20000).cast("int")).cast("string")
    patients = c.select(subject, F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("GENDER"), born.alias("DOB"))
    admissions = c.select(subject, stay, F.lit("1990-06-01 10:00:00").alias("ADMITTIME"), F.col("n_name").alias("ETHNICITY"), F.lit(None).cast("string").alias("INSURANCE"), F.lit("EMERGENCY").alias("ADMISSION_TYPE"), (F.col("c_nationkey") % 2).alias("HOSPITAL_EXPIRE_FLAG"))
    diagnoses = c.select(subject, stay, F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("SEQ_NUM"), F.lit("D1").alias("ICD9_CODE"))
    return D.matched_people(c.select(F.concat_ws("_", "c_custkey", "c_nationkey").alias("patient_id")), patients, admissions, diagnoses)
