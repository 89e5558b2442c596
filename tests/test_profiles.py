"""Names that meet patterns by trigrams, column profiles, picks that are filled up."""

import re

from pyspark.sql import functions as F

from bedside.operators import aggregates, mapping, trajectory
from bedside.plans import splits

PATTERNS = ["ring", "^heart rate", "ab*cde", "sp.?o2", "(?i)HEART", "rate|oxygen", "o2$", "ox+ygen", "a+?b", "zzzq", "h[ea]art", "x\\.y", ".", "potas+ium", "", "é.?lan vital"]
NAMES = ["heart rate", "Heart Rate", "ring", "acde", "abbbcde", "spo2", "sp-o2", "oxygen", "oxxygen", "potassium", "x.y", "élan vital", "éxlan vital", "ab", "", None, "rate of rings"]


def test_trigram_candidates_equal_a_scan_of_all_pairs(spark):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    targets = spark.createDataFrame([(i, p) for i, p in enumerate(PATTERNS)] + [(99, None)], "target int, pattern string")
    hits = mapping.candidates(names, targets, "name", "pattern", "target", 100)
    got = sorted((r.target, r.name) for r in hits.collect())
    want = sorted((i, n) for i, p in enumerate(PATTERNS) for n in NAMES if n is not None and re.search(p, n))
    assert got == want
    plan = hits._jdf.queryExecution().optimizedPlan().toString() + hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert mapping.candidates(names.limit(0), targets, "name", "pattern", "target").count() == 0
    assert mapping.candidates(names, targets.limit(0), "name", "pattern", "target").count() == 0


def test_needed_trigrams(spark):
    rows = spark.createDataFrame([("^heart",), ("abcd*e",), ("a.bcd",), ("abc|x",), ("ab",), ("abc+d",), (None,)], "p string")
    got = [None if r.p is None else r.g for r in rows.select("p", mapping.needed_trigrams(F.col("p")).alias("g")).collect()]
    assert [sorted(g) if g is not None else g for g in got] == [["ear", "art", "hea"].__class__(sorted(["hea", "ear", "art"])), ["abc"], ["bcd"], [], [], ["abc"], None]


def test_profile_of_wide_rows(spark):
    rows = spark.createDataFrame([(1, "a", 0.0, True, None), (1, None, -0.0, None, None), (2, "a", float("nan"), False, None)], "k int, `odd name` string, x double, b boolean, empty string")
    plan = aggregates.column_profile(rows)
    got = {r.column: (r.kind, r.n_null, r.n_distinct, r.low, r.high) for r in plan.collect()}
    assert got["k"] == ("int", 0, 2, "1", "2") and got["odd name"] == ("string", 1, 1, "a", "a")
    assert got["x"][2] == 2 and got["b"][1:3] == (1, 2) and got["empty"] == ("string", 3, 0, None, None)
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {r.column: r.n_distinct for r in aggregates.column_profile(rows, exact=False).collect()}["k"] == 2
    assert all(r.n_distinct == 0 for r in aggregates.column_profile(rows.limit(0)).collect())


def test_rows_per_year_in_utc(spark):
    rows = spark.createDataFrame([(0,), (-1,), (31_536_000_000,), (None,)], "t long")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r.year: r.n for r in aggregates.rows_per_year(rows, "t").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {1970: 1, 1969: 1, 1971: 1, None: 1}


def test_leaking_entities_are_named(spark):
    rows = spark.createDataFrame([("a", "future", 200), ("a", "future", 307), ("b", "events", 200), ("c", "future", 100)], "entity_id string, part string, var_id int")
    assert [(r.entity_id, r.leaks) for r in trajectory.leaking(trajectory.part_summary(rows)).collect()] == [("a", ["actions", "onset"])]


def test_pick_is_filled_up_from_outside_the_list(spark):
    people = spark.createDataFrame([(i, i % 2) for i in range(20)], "id int, died int")
    listed = spark.createDataFrame([(1,), (1,), (3,), (4,), (None,), (77,)], "id int")
    got = splits.filled_pick(people, listed, ["died"], "id", 6).collect()
    assert [r.id in (1, 3, 4) for r in got] == [True] * 3 + [False] * 3 and len({r.id for r in got}) == 6
    assert {r.id for r in splits.filled_pick(people, listed, ["died"], "id", 2).collect()} & {4} == {4}
    assert splits.filled_pick(people, listed.limit(0), ["died"], "id", 50).count() == 20
