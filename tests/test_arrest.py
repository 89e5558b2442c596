"""Exploded offsets of monitors are not broadcast."""

from bedside.queries import QUERIES


def test_exploded_offsets_are_not_broadcast(spark):
    plan = QUERIES["cohort_arrest_monitors"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "wynton_folder" in line]
    assert joins and not any("Broadcast" in line for line in joins)
