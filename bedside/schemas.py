"""Canonical tables as DDL schemas, and the constants that they share."""

# Fixed values of the canonical layout.
SEG_BASELINE, SEG_RECENT, SEG_FUTURE = -2147483648, -2147483647, -2147483646
PARTS = ("baseline", "recent", "events", "future")
SEGMENT_MS = 30_000
HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
CONTEXT_MS, BASELINE_CAP_MS, FUTURE_CAP_MS = DAY_MS, 30 * DAY_MS, 7 * DAY_MS
BANDS = {"lab": (0, 99), "vital": (100, 199), "action": (200, 299), "score": (300, 399)}

EVENTS = "dataset string, entity_id string, time_ms bigint, seg_idx int, var_id int, value float, part string"
PRE_ALIGNED = "entity_id string, time_ms bigint, var_id int, value float"
SEG_AXIS = "entity_id string, seg_idx int, time_ms bigint"
SEGMENTS = "entity_id string, seg_idx int, time_ms bigint, channel string, fs int, samples array<float>"
RAW_CHUNKS = "entity_id string, channel string, start_ms bigint, fs int, samples array<float>, ord bigint"
REGISTRY = "var_id int, name string, category string, unit string, physio_min double, physio_max double, codes map<string,array<string>>, conversions map<string,string>"
SPLITS = "entity_id string, split string"
COHORT = "entity_id string, patient_id string, start_ms bigint, end_ms bigint"
