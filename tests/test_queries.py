"""Registered queries against their DuckDB oracles, on the smallest given tables."""

import os
from decimal import Decimal

import pytest

from bedside.queries import ORACLES, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ["trajectory_parts", "as_of_nearest", "as_of_strict", "as_of_forward", "coverage", "sample_index_middle", "throttle_labels", "dense_grid", "resp_score", "cardio_score", "best_overlap", "covering_chunk", "stratified_split", "patient_split_floor", "vasopressor_rate", "numeric_texts", "local_times", "repaired_lines", "decoded_samples", "grid_placement", "anchor_blocks", "split_coverage", "assembled", "manifest", "sample_waves", "sample_index_throttled", "trajectory_files", "delimited_files", "registry_file", "split_list_files", "charted_values", "organ_scores", "range_override", "fluids", "part_summary", "cohort_icu_lists", "demographics_icu", "cohort_arrest_monitors", "demographics_arrest", "cohort_ed_visits", "demographics_visits", "cohort_or_monitors", "demographics_or_monitors", "cohort_or_records", "demographics_or_records", "cohort_surgical_cases", "demographics_cases", "cohort_matched_recordings", "demographics_matched",
    "points_in_spans", "throttle_common_keys", "overlaid_chunks", "assembled_seconds", "record_files", "record_ranges", "raw_chunks", "monitor_files", "sample_transforms",
    "merged_store", "replaced_in_store", "checked_write", "stored_samples",
    "name_candidates", "column_profile", "rows_per_year", "leaking_entities", "filled_pick", "scanned_headers", "scanned_files"]


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "shape", ()):
        return tuple(plain(x) for x in v)
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, (float, Decimal)) or "float" in type(v).__name__:
        return round(float(v), 6)
    return int(v) if hasattr(v, "__int__") and not isinstance(v, str) else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("the given tables aren't here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SOME)
def test_query_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    places = [want.columns.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in places) for r in want.fetchall()), key=str)
    assert mine == theirs


def test_entry_and_registry():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(QUERIES) <= names and set(entry.oracle_sql()) <= names
