"""Cohorts and demographics of seven kinds of hospital export.

What differs between exports is data: names of columns, time formats and zones, bounds, order and
rounding of the demographics file. The steps are shared: read an export's columns, aggregate side tables
to one row per key, join, keep valid intervals, one row per entity. Side tables are joined on the
entity's or encounter's key after their own aggregation, so no join multiplies a hot key, except the
attribution of files to surgeries, which meets in hour-wide buckets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside.functions import clean as C
from bedside.functions import timebase as T
from bedside.operators.dedup import first_per
from bedside.plans.demographics import demographics, primary_diagnosis

DAY, HOUR = 86_400_000, 3_600_000


@dataclass(frozen=True)
class Export:
    """How one table of texts is read: new names and source columns, types, and times as UTC milliseconds."""

    columns: dict[str, str]
    kinds: dict[str, str] = field(default_factory=dict)
    times: dict[str, str] = field(default_factory=dict)
    #: Without a format, ISO 8601; with one, wall time of ``zone``.
    fmt: str | None = None
    zone: str = "UTC"

    def read(self, rows: DataFrame) -> DataFrame:
        def plain(name: str) -> Column:
            text = F.col(self.columns[name])
            return text.try_cast(self.kinds[name]) if name in self.kinds else text

        def at(name: str) -> Column:
            text = F.col(self.times[name])
            return T.local_to_ms(text, self.fmt, self.zone) if self.fmt else T.zulu_to_ms(text)

        return rows.select(*(plain(n).alias(n) for n in self.columns), *(at(n).alias(n) for n in self.times))


# Column names of the exports and of the cohort tables, formats and zones.
ICU_TASKS = Export(
    {"encounter_nbr": "encounter_nbr", "hours": "valid_duration_hour", "ratio": "valid_ratio", "type": "type", "record": "wfdb_record"},
    {"encounter_nbr": "bigint", "hours": "double", "ratio": "double"},
    {"valid_start_ms": "valid_start", "valid_end_ms": "valid_end", "sepsis_time_zero_ms": "sepsis_time_zero_dttm"},
)
ICU_RECORDINGS = Export(
    {"encounter_nbr": "encounter_nbr", "empi_nbr": "empi_nbr", "record": "wfdb_record"},
    {"encounter_nbr": "bigint", "empi_nbr": "bigint"},
    {"wave_start_ms": "wfdb_start", "wave_end_ms": "wfdb_end"},
)
ICU_ENCOUNTERS = Export(
    {
        "encounter_nbr": "ENCOUNTER_NBR",
        "pat_id": "PAT_ID",
        "age": "AGE",
        "admit_dx_icd10": "DIAGNOSIS_ICD10_CD",
        "admit_dx_desc": "DIAGNOSIS_ICD10_DESC",
        "encounter_type": "ENCOUNTER_TYPE",
        "insurance_status": "INSURANCE_STATUS",
        "entity_healthcare_nm": "ENTITY_HEALTHCARE_NM",
    },
    {"encounter_nbr": "bigint", "age": "int"},
    {"admit_ms": "HOSPITAL_ADMISSION_DATE_TIME", "discharge_ms": "HOSPITAL_DISCHARGE_DATE_TIME"},
    "MM/dd/yyyy HH:mm:ss",
    "America/New_York",
)
ICU_PEOPLE = Export({"pat_id": "PAT_ID", "gender": "GENDER", "dob": "DOB", "race": "RACE", "ethnicity": "ETHNICITY", "death": "DEATH_DATE"})
DEATH_FORMATS = ["MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]
ARREST_LABELS = Export(
    {"raw_id": "Patient_ID_GE", "wave_cycle_uid": "WaveCycleUID", "wynton_folder": "Wynton_folder", "unit_bed": "UnitBed", "event_time_raw": "EventTime"},
    times={"episode_start_ms": "ValidStartTime", "episode_end_ms": "ValidStopTime"},
)
ARREST_OFFSETS = Export(
    {
        "patient_id_ge": "Patient_ID_GE",
        "wynton_folder": "Wynton_folder",
        "encounter_id": "Encounter_ID",
        "patient_id": "Patient_ID",
        "offset_days": "offset",
        "offset_ge_days": "offset_GE",
        "encounter_los_days": "Encounter_LOS",
    },
    {"encounter_id": "bigint", "offset_days": "bigint", "offset_ge_days": "bigint", "encounter_los_days": "bigint"},
    {"encounter_start_ms": "Encounter_Start_time"},
)
VISITS = Export(
    {
        "entity_id": "CSN",
        "csn": "CSN",
        "mrn": "MRN",
        "visit_no": "Visit_no",
        "visits_total": "Visits",
        "ed_los_hours": "ED_LOS",
        "hosp_los_days": "Hosp_LOS",
        "age": "Age",
        "gender": "Gender",
        "race": "Race",
        "ethnicity": "Ethnicity",
        "means_of_arrival": "Means_of_arrival",
        "triage_acuity": "Triage_acuity",
        "chief_complaint": "CC",
        "ed_dispo": "ED_dispo",
        "admit_service": "Admit_service",
        "dx_icd10": "Dx_ICD10",
        "dx_name": "Dx_name",
        "payor_class": "Payor_class",
    },
    {"csn": "bigint", "mrn": "bigint", "age": "int", "ed_los_hours": "double", "hosp_los_days": "double"},
    {"arrival_ms": "Arrival_time", "roomed_ms": "Roomed_time", "dispo_ms": "Dispo_time", "admit_ms": "Admit_time", "departure_ms": "Departure_time"},
)
WAVE_TYPES = {"Pleth": "pleth", "II": "ii", "Resp": "resp"}
OR_PATIENTS = Export(
    {"pid": "PID", "age": "Age", "gender": "Gender", "height_cm": "Ht", "weight_kg": "Wt", "procedure": "Procedure"},
    {"age": "int", "height_cm": "float", "weight_kg": "float"},
    {"or_start_ms": "OR_start", "or_end_ms": "OR_end", "surgery_start_ms": "Surgery_start", "surgery_end_ms": "Surgery_end"},
    "M/d/yy H:mm",
    "America/Los_Angeles",
)
SURGERIES = Export(
    {
        "log_id": "LOG_ID",
        "mrn": "MRN",
        "los_days": "LOS",
        "icu_admin_flag": "ICU_ADMIN_FLAG",
        "birth_date": "BIRTH_DATE",
        "height_cm": "HEIGHT",
        "weight_kg": "WEIGHT",
        "sex": "SEX",
        "anes_type": "PRIMARY_ANES_TYPE_NM",
        "asa_rating": "ASA_RATING",
        "patient_class_nm": "PATIENT_CLASS_NM",
        "procedure": "PRIMARY_PROCEDURE_NM",
        "disch_disp": "DISCH_DISP",
    },
    {"los_days": "double", "height_cm": "double", "weight_kg": "double"},
    {
        "hosp_admsn_ms": "HOSP_ADMSN_TIME",
        "hosp_disch_ms": "HOSP_DISCH_TIME",
        "in_or_ms": "IN_OR_DTTM",
        "out_or_ms": "OUT_OR_DTTM",
        "an_start_ms": "AN_START_DATETIME",
        "an_stop_ms": "AN_STOP_DATETIME",
    },
    "M/d/yy H:mm",
    "America/Los_Angeles",
)
SURGERY_SPANS = {"in_or_ms": "out_or_ms", "an_start_ms": "an_stop_ms"}
CROSSWALK = Export({"pat_id": "PAT_ID", "log_id": "LOG_ID"})
MONITOR_FILE = r"([0-9a-f]{16})(CB|IP)-(\d{4}-\d{2}-\d{2}-\d{2}-\d{2}-\d{2}-\d{3})Z\.xml$"
CASE_SECONDS = {"casestart": "casestart_s", "caseend": "caseend_s", "anestart": "anestart_s", "aneend": "aneend_s", "opstart": "opstart_s", "opend": "opend_s", "adm": "adm_s", "dis": "dis_s"}
CASE_TEXTS = ["sex", "emop", "department", "optype", "dx", "opname", "approach", "position", "ane_type"]
CASE_NUMBERS = {"age": "double", "height": "double", "weight": "double", "bmi": "double", "asa": "int", "icu_days": "int", "death_inhosp": "int"}
CASE_NAMES = {"height": "height_cm", "weight": "weight_kg"}
LEAST_SECONDS = 300


def icu_lists(tasks: DataFrame, recordings: DataFrame, encounters: DataFrame) -> DataFrame:
    """Recorded encounters with a task: valid time from the task list, the whole span from the recording list.

    Type and onset are those of the earliest task (of equal starts the least record).
    """
    t = ICU_TASKS.read(tasks).groupBy("encounter_nbr").agg(
        F.min(F.struct("valid_start_ms", "record", "type", "sepsis_time_zero_ms")).alias("first"),
        F.min("valid_start_ms").alias("valid_start_ms"),
        F.max("valid_end_ms").alias("valid_end_ms"),
        F.sum("hours").alias("valid_duration_hour_sum"),
        F.avg("ratio").alias("valid_ratio_mean"),
        F.sort_array(F.collect_set("record")).alias("wfdb_records"),
    )
    r = ICU_RECORDINGS.read(recordings).groupBy("encounter_nbr").agg(
        F.min("empi_nbr").alias("empi_nbr"),
        F.min("wave_start_ms").alias("wave_start_ms"),
        F.max("wave_end_ms").alias("wave_end_ms"),
        F.sort_array(F.collect_set("record")).alias("wfdb_records_all"),
    )
    e = ICU_ENCOUNTERS.read(encounters)
    e = first_per(e, ["encounter_nbr"], ["admit_ms", "discharge_ms", "pat_id"])
    out = t.join(r, "encounter_nbr").join(e, "encounter_nbr", "left")
    return out.withColumns(
        {
            "entity_id": F.concat_ws("_", F.col("empi_nbr").cast("string"), F.col("encounter_nbr").cast("string")),
            "type": F.col("first.type"),
            "sepsis_time_zero_ms": F.col("first.sepsis_time_zero_ms"),
            "los_days": (F.col("discharge_ms") - F.col("admit_ms")) / DAY,
            "wave_duration_days": (F.col("wave_end_ms") - F.col("wave_start_ms")) / DAY,
            "valid_duration_hour_max": C.hours_between(F.col("valid_start_ms"), F.col("valid_end_ms")),
            "n_wfdb_records": F.size("wfdb_records_all"),
        }
    ).drop("first")


def icu_people(cohort: DataFrame, people: DataFrame) -> DataFrame:
    """``cohort`` with birth date and time of death of its patients: a date without time is midnight of the site."""
    p = first_per(ICU_PEOPLE.read(people), ["pat_id"], ["dob", "gender", "race", "ethnicity", "death"])
    death = F.coalesce(*(T.local_to_ms(F.col("death"), f, ICU_ENCOUNTERS.zone) for f in DEATH_FORMATS))
    dob = F.date_format(F.try_to_timestamp(F.col("dob"), F.lit("yyyy-MM-dd")), "yyyy-MM-dd")
    return cohort.join(p.withColumns({"death_date_utc_ms": death, "dob_iso": dob}).drop("dob", "death"), "pat_id", "left")


def arrest_monitors(labels: DataFrame, offsets: DataFrame) -> DataFrame:
    """Monitored episodes with arrest labels, each with its candidate encounters moved onto the monitor's time.

    An entity with several candidates has a row for each, and their number; the two
    offsets of a patient differ by whole days.
    """
    texts = {c: F.trim(F.col(c)) for c in ARREST_LABELS.columns}
    rows = ARREST_LABELS.read(labels).withColumns(texts)
    seconds = (F.col("episode_end_ms") - F.col("episode_start_ms")) / 1000
    rows = rows.withColumns({"patient_id_ge": C.without_prefix(F.col("raw_id"), "DE"), "episode_duration_sec": seconds}).where("episode_duration_sec > 0")
    rows = rows.withColumns(
        {
            "entity_id": F.concat_ws("_", "patient_id_ge", "wave_cycle_uid"),
            "bed_subdir": F.concat_ws("-", "unit_bed", "raw_id"),
            "has_ca": T.has_event(F.col("event_time_raw")).cast("int"),
        }
    ).drop("raw_id")
    keys = ["patient_id_ge", "wynton_folder"]
    o = ARREST_OFFSETS.read(offsets).withColumns({k: F.trim(F.col(k)) for k in keys})
    start = T.shift_days(F.col("encounter_start_ms"), F.col("offset_ge_days") - F.col("offset_days"))
    o = o.withColumn("admission_start_ms", start).withColumn("admission_end_ms", F.col("admission_start_ms") + F.col("encounter_los_days") * DAY).drop("encounter_start_ms")
    # Spark's estimate of a list that was exploded is too small, and would have it broadcast.
    joined = rows.join(o.hint("merge"), keys, "left")
    return joined.join(joined.groupBy("entity_id").agg(F.count("*").alias("n_candidate_encounters")), "entity_id")


def ed_visits(waves: DataFrame, visits: DataFrame) -> DataFrame:
    """Visits with a plethysmogram and a valid stay. ``waves``: CSN, Type, Segments, Duration, one row per type."""
    def value(kind: str, column: str, to: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("Type") == kind, F.col(column).try_cast(to))), F.lit(0).cast(to))

    wide = waves.groupBy(F.col("CSN").cast("string").alias("entity_id")).agg(
        *(value(k, "Segments", "int").alias(f"n_{n}_seg") for k, n in WAVE_TYPES.items()),
        *(value(k, "Duration", "double").alias(f"duration_{n}_s") for k, n in WAVE_TYPES.items()),
    )
    rows = VISITS.read(visits).where(C.valid_interval(F.col("arrival_ms"), F.col("departure_ms")))
    return first_per(rows, ["entity_id"], ["arrival_ms", "departure_ms", "visit_no"]).join(wide.where("n_pleth_seg >= 1"), "entity_id")


def or_monitors(patients: DataFrame, files: DataFrame) -> DataFrame:
    """Patients with monitor files and a valid time in the operating room. ``files``: pid, path."""
    rows = OR_PATIENTS.read(patients).where(C.valid_interval(F.col("or_start_ms"), F.col("or_end_ms")))
    return rows.join(files.groupBy("pid").agg(F.count("*").alias("n_xml_files")), "pid").withColumn("entity_id", F.col("pid"))


def or_records(crosswalk: DataFrame, surgeries: DataFrame, files: DataFrame, around_ms: int = HOUR) -> DataFrame:
    """Surgeries with the monitor files taken from an hour before anaesthesia to an hour after it.

    A patient may have many files and several surgeries: files meet windows by patient
    and hour, so a patient's files are spread and no pair outside a window is made but
    those of the two hours at its ends. ``files``: path. Years have two digits, so a stop within a day of a start
    on the last evening of a century is read into the next one.
    """
    read = SURGERIES.read(surgeries)
    read = read.withColumns({b: T.next_century(F.col(a), F.col(b), SURGERIES.zone) for a, b in SURGERY_SPANS.items()})
    info = first_per(read, ["log_id"], ["an_start_ms", "an_stop_ms", "mrn"])
    info = info.where(C.valid_interval(F.col("an_start_ms"), F.col("an_stop_ms")))
    windows = CROSSWALK.read(crosswalk).distinct().join(info.select("log_id", "an_start_ms", "an_stop_ms"), "log_id")
    low, high = F.col("an_start_ms") - around_ms, F.col("an_stop_ms") + around_ms
    hours = F.explode(F.sequence(F.floor(low / HOUR), F.floor(high / HOUR))).alias("hour")
    windows = windows.select("pat_id", "log_id", low.alias("low"), high.alias("high"), hours).hint("merge")  # sizes are estimated without the hours
    pat, taken = (F.regexp_extract("path", MONITOR_FILE, i) for i in (1, 3))
    named = files.select("path", F.nullif(pat, F.lit("")).alias("pat_id"), F.unix_millis(F.try_to_timestamp(taken, F.lit("yyyy-MM-dd-HH-mm-ss-SSS"))).alias("file_ms"))
    named = named.where("pat_id IS NOT NULL").withColumn("hour", F.floor(F.col("file_ms") / HOUR))
    inside = named.join(windows, ["pat_id", "hour"]).where(F.col("file_ms").between(F.col("low"), F.col("high")))
    per = inside.groupBy("log_id").agg(
        F.sort_array(F.collect_set("path")).alias("xml_paths"),
        F.count_distinct("path").alias("n_xml_files"),
        F.min("file_ms").alias("xml_ms_min"),
        F.max("file_ms").alias("xml_ms_max"),
    )
    return info.join(per, "log_id").withColumn("entity_id", F.col("log_id"))


def surgical_cases(cases: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """Cases with a recording and anaesthesia that ends after it starts; times are seconds from the case's start. ``files``: path."""
    entity = C.padded_id(F.col("caseid"), 4)
    rows = cases.select(
        entity.alias("entity_id"),
        F.col("caseid").try_cast("bigint").alias("caseid"),
        F.col("subjectid").try_cast("bigint").alias("subjectid"),
        *(F.col(c).try_cast("double").alias(n) for c, n in CASE_SECONDS.items()),
        *(F.col(c).try_cast(k).alias(CASE_NAMES.get(c, c)) for c, k in CASE_NUMBERS.items()),
        *CASE_TEXTS,
        F.concat(F.lit(f"{folder}/"), entity, F.lit(".vital")).alias("vital_file_path"),
    )
    rows = rows.where(C.valid_interval(F.col("anestart_s"), F.col("aneend_s"), strict=True))
    rows = rows.join(files.select(F.col("path").alias("vital_file_path")), "vital_file_path", "left_semi")
    return first_per(rows, ["entity_id"], ["anestart_s", "aneend_s", "subjectid"])


def matched_recordings(inventory: DataFrame, labs: DataFrame, vitals: DataFrame, least_s: float = LEAST_SECONDS, least_events: int = 1) -> DataFrame:
    """Recordings with both main channels long enough whose patient has charted events.

    ``inventory``: patient_id, subject_id, has_pleth, has_ii, pleth_duration_sec, ii_duration_sec;
    ``labs`` and ``vitals``: subject_id, var_id.
    """
    long = inventory.where("has_pleth AND has_ii").where((F.col("pleth_duration_sec") >= least_s) & (F.col("ii_duration_sec") >= least_s))
    # One pass over both event tables; counts of an entity come from counts per variable, so that no key is hot.
    both = labs.select("subject_id", "var_id", F.lit("lab").alias("kind")).unionByName(vitals.select("subject_id", "var_id", F.lit("vital").alias("kind")))
    per_variable = both.groupBy("subject_id", "kind", "var_id").agg(F.count("*").alias("n"))
    counts = per_variable.groupBy("subject_id").agg(
        *(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n_{k}_events") for k in ("lab", "vital")),
        *(F.count_if((F.col("kind") == k) & F.col("var_id").isNotNull()).alias(f"n_{k}_variables") for k in ("lab", "vital")),
        F.count_distinct("var_id").alias("n_vars"),
    )
    names = ["n_lab_events", "n_vital_events", "n_lab_variables", "n_vital_variables", "n_vars"]
    out = long.join(counts, "subject_id", "left").fillna(0, names)
    out = out.withColumns({"n_total_ehr": F.col("n_lab_events") + F.col("n_vital_events"), "n_total_variables": F.col("n_lab_variables") + F.col("n_vital_variables")})
    return out.where(F.col("n_total_ehr") >= least_events)


def matched_people(entities: DataFrame, patients: DataFrame, admissions: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Demographics of recordings named subject_admission; names of other forms are left out.

    Columns of ``diagnoses``: SUBJECT_ID, HADM_ID, SEQ_NUM, ICD9_CODE.
    """
    subject, admission = (F.regexp_extract("patient_id", r"^(\d+)_(\d+)$", i).try_cast("bigint") for i in (1, 2))
    e = entities.select("patient_id", subject.alias("SUBJECT_ID"), admission.alias("HADM_ID")).where("SUBJECT_ID IS NOT NULL").distinct()
    keys = ["SUBJECT_ID", "HADM_ID"]
    d = diagnoses.select(F.struct(*keys).alias("stay"), F.col("SEQ_NUM").alias("seq_num"), F.col("ICD9_CODE").alias("code"))
    d = primary_diagnosis(d, "stay").select("stay.*", "primary_code")
    joined = demographics(e, [(patients, ["SUBJECT_ID"]), (admissions, keys), (d, keys)])
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return joined.select(
        "patient_id",
        F.col("SUBJECT_ID").alias("subject_id"),
        F.col("HADM_ID").alias("hadm_id"),
        text("GENDER").alias("gender"),
        C.age(F.to_date("DOB"), F.to_date("ADMITTIME")).alias("age_years"),
        text("ETHNICITY").alias("ethnicity"),
        text("INSURANCE").alias("insurance"),
        text("ADMISSION_TYPE").alias("admission_type"),
        text("primary_code").alias("icd9_primary"),
        F.coalesce(F.col("HOSPITAL_EXPIRE_FLAG").cast("int"), F.lit(0)).alias("died_in_hospital"),
    )


# Columns of the demographics file by kind of export (name of the file's own: name in the cohort), and decimal places.
WAVE = {"wave_start_ms": "wave_start_ms", "wave_end_ms": "wave_end_ms"}
FILES: dict[str, dict[str, str]] = {
    "icu": {n: n for n in ["entity_id", "empi_nbr", "encounter_nbr", "pat_id", "gender", "dob_iso"]}
    | {"age_years": "age", "race": "race", "ethnicity": "ethnicity", "insurance": "insurance_status", "admit_utc_ms": "admit_ms", "discharge_utc_ms": "discharge_ms"}
    | {n: n for n in ["los_days", "admit_dx_icd10", "admit_dx_desc", "entity_healthcare_nm", "death_date_utc_ms"]}
    | WAVE
    | {"type": "type"},
    "arrest": {"entity_id": "entity_id", "patient_id_ge": "patient_id_ge", "encounter_id": "encounter_id", "age_years": "age", "gender": "", "ethnicity": "", "insurance": ""}
    | {"admission_type": "admit_type", "los_days": "encounter_los_days", "admission_start_ms": "admission_start_ms", "admission_end_ms": "admission_end_ms"}
    | WAVE
    | {"has_ca": "has_ca"},
    "visits": {n: n for n in ["entity_id", "csn", "mrn", "visit_no", "visits_total", "gender", "age", "race", "ethnicity", "means_of_arrival", "triage_acuity", "chief_complaint", "ed_dispo", "admit_service", "payor_class", "dx_icd10", "dx_name"]}
    | {"arrival_utc_ms": "arrival_ms", "departure_utc_ms": "departure_ms", "admit_utc_ms": "admit_ms", "dispo_utc_ms": "dispo_ms", "ed_los_hours": "ed_los_hours", "hosp_los_days": "hosp_los_days"}
    | WAVE,
    "or_monitors": {n: n for n in ["entity_id", "pid", "gender", "age", "height_cm", "weight_kg", "procedure", "or_start_ms", "or_end_ms", "surgery_start_ms", "surgery_end_ms"]} | WAVE | {"n_xml_files": "n_xml_files"},
    "or_records": {n: n for n in ["entity_id", "log_id", "mrn", "sex", "birth_date", "height_cm", "weight_kg", "asa_rating", "anes_type", "patient_class_nm", "procedure", "icu_admin_flag", "hosp_admsn_ms", "hosp_disch_ms", "in_or_ms", "out_or_ms", "an_start_ms", "an_stop_ms", "los_days"]}
    | WAVE
    | {"n_xml_files": "n_xml_files"},
    "cases": {n: n for n in ["entity_id", "caseid", "subjectid", "age", "sex", "height_cm", "weight_kg", "bmi", "asa", "emop", "department", "optype", "dx", "opname", "approach", "position", "ane_type", "icu_days", "death_inhosp", "anestart_s", "aneend_s", "opstart_s", "opend_s", "adm_s", "dis_s"]} | WAVE,
}
PLACES = {
    "icu": {"los_days": 3},
    "arrest": {},
    "visits": {"ed_los_hours": 3, "hosp_los_days": 3},
    "or_monitors": {"height_cm": 1, "weight_kg": 2},
    "or_records": {"height_cm": 1, "weight_kg": 2, "los_days": 2},
    "cases": {"height_cm": 1, "weight_kg": 2, "bmi": 2},
}


def demographics_file(kind: str, cohort: DataFrame, waves: DataFrame | None = None) -> DataFrame:
    """Rows of the demographics file of one kind of export, for entities whose recording was written.

    ``waves``: entity_id, wave_start_ms, wave_end_ms of those; None if ``cohort`` has the
    bounds and nothing else than written entities. Of several candidate encounters the
    least one counts. A column that an export lacks is null.
    """
    rows = cohort if waves is None else cohort.join(waves.select("entity_id", *WAVE), "entity_id")
    rows = first_per(rows, ["entity_id"], ["encounter_id"]) if kind == "arrest" else rows

    def out(name: str, source: str) -> Column:
        if not source or source not in rows.columns:
            return F.lit(None).cast("string").alias(name)
        places = PLACES[kind].get(name)
        return (F.col(source) if places is None else F.bround(F.col(source).cast("double"), places)).alias(name)

    return rows.select(*(out(n, s) for n, s in FILES[kind].items()))
