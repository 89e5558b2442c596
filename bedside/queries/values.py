"""Queries on scalar functions, reshaping and text repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from bedside.functions import clean as C
from bedside.functions import timebase as X
from bedside.operators import aggregates as A
from bedside.operators import dedup, mapping
from bedside.queries.common import query, raw_events, table, utc_millis
from bedside.sources import delimited, headers, monitors

MS = "epoch_us(o_orderdate) // 1000"


def _day(column: str, fmt: str):
    """Text of a date without zone, whatever the session's zone."""
    return F.date_format(F.col(column).cast("date"), fmt)


@query(f"SELECT o_orderkey, {MS} + (o_orderkey % 24) * 3600000 + 250 AS ms FROM orders")
def iso_times(spark, sf):
    o = table(spark, sf, "orders")
    text = F.concat(_day("o_orderdate", "yyyy-MM-dd"), F.lit("T"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00:00.250Z"))
    return o.select("o_orderkey", X.zulu_to_ms(text).alias("ms"))


@query("""SELECT o_orderkey, epoch_us(timezone('America/New_York', CAST(strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(4 + o_orderkey % 20 AS VARCHAR), 2, '0') || ':30:00' AS TIMESTAMP))) // 1000 AS ms FROM orders""")
def local_times(spark, sf):
    o = table(spark, sf, "orders")
    text = F.concat(_day("o_orderdate", "MM/dd/yyyy"), F.lit(" "), F.lpad((4 + F.col("o_orderkey") % 20).cast("string"), 2, "0"), F.lit(":30:00"))
    return o.select("o_orderkey", X.local_to_ms(text, "MM/dd/yyyy HH:mm:ss", "America/New_York").alias("ms"))


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE {MS} END AS ms FROM orders")
def first_format(spark, sf):
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 3 == 0, _day("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, _day("o_orderdate", "MM/dd/yyyy")).otherwise("soon")
    return o.select("o_orderkey", X.first_format_to_ms(text, ["yyyy-MM-dd", "MM/dd/yyyy"]).alias("ms"))


@query(f"SELECT o_orderkey, {MS} + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 45000000 END AS ms FROM orders")
def date_and_time(spark, sf):
    o = table(spark, sf, "orders")
    both = X.date_and_time(_day("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise("12:30:00"))
    return o.select("o_orderkey", X.first_format_to_ms(both, ["yyyy/MM/dd HH:mm:ss"]).alias("ms"))


@query(f"SELECT o_orderkey, epoch_us(o_orderdate + INTERVAL 30 YEAR) // 1000 + 5000 AS years_ms, {MS} - (o_custkey % 7) * 86400000 AS days_ms FROM orders")
def date_shifts(spark, sf):
    o = table(spark, sf, "orders").withColumn("ms", utc_millis("o_orderdate"))
    return o.select("o_orderkey", X.shift_years(F.col("ms") + 5000, 30).alias("years_ms"), X.shift_days(F.col("ms"), F.col("o_custkey") % 7).alias("days_ms"))


@query("SELECT l_orderkey, l_linenumber, CAST(trunc((l_orderkey + l_quantity / 8) * 1000) AS BIGINT) AS relative_ms, CAST(l_orderkey * 1000 + floor(l_linenumber * 1000 / 40) AS BIGINT) AS sample_ms FROM lineitem")
def relative_times(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", X.relative_to_ms(F.col("l_orderkey"), F.col("l_quantity") / 8).alias("relative_ms"), X.sample_ms(F.col("l_orderkey") * 1000, F.col("l_linenumber"), F.lit(40)).alias("sample_ms"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE epoch_us(o_orderdate) // 1000 END AS event_ms, o_orderstatus <> 'O' AS has_event FROM orders")
def event_markers(spark, sf):
    text = F.when(F.col("o_orderstatus") == "O", "-1").otherwise(_day("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", X.marker_ms(text, "yyyy-MM-dd").alias("event_ms"), X.has_event(text).alias("has_event"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 6 WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE l_quantity END AS value, CASE WHEN l_linenumber % 6 IN (4, 5) THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS whole FROM lineitem""")
def numeric_texts(spark, sf):
    q = F.col("l_quantity").cast("string")
    k = F.col("l_linenumber") % 6
    text = F.when(k == 0, q).when(k == 1, F.concat(F.lit("<"), q)).when(k == 2, F.concat(F.lit(" "), q, F.lit("% "))).when(k == 3, F.concat(F.lit("~+"), q)).when(k == 4, "abc").otherwise("NaN")
    bare = F.when(k < 4, q).when(k == 4, "abc").otherwise("NaN")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", C.numeric_text(text).alias("value"), C.safe_int(bare).alias("whole"))


@query("SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN NULL ELSE p_type END AS p_type FROM part")
def null_tokens(spark, sf):
    return C.null_tokens(table(spark, sf, "part").select("p_partkey", "p_type"), ["PROMO", "LARGE"], ["p_type"])


@query("SELECT p_partkey, upper(trim(p_name)) AS code, CASE WHEN split_part(p_name, ' ', -1) IN ('ring', 'gear') THEN split_part(p_name, ' ', -1) ELSE 'C ' || p_name END AS label, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS padded, regexp_replace(p_brand, '^Brand', '') AS brand, right(p_brand, 2) AS tail FROM part")
def code_texts(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", C.code_text(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("code"), C.garbled_label(F.concat(F.lit("C "), F.col("p_name")), ["ring", "gear"]).alias("label"), F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("padded"), F.regexp_replace("p_brand", "^Brand", "").alias("brand"), F.right("p_brand", F.lit(2)).alias("tail"))


URL = r"^https?://([^/]+)/([a-z]+)/([0-9]+)"


@query(f"SELECT page_id, regexp_extract(url, '{URL}', 1) AS host, regexp_extract(url, '{URL}', 2) AS lang, TRY_CAST(regexp_extract(url, '{URL}', 3) AS BIGINT) AS number FROM pages")
def path_patterns(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", URL, 1).alias("host"), F.regexp_extract("url", URL, 2).alias("lang"), F.regexp_extract("url", URL, 3).try_cast("bigint").alias("number"))


@query(f"SELECT regexp_extract(url, '{URL}', 2) AS entity_id, count(*) AS n_files, CAST(sum(length(url)) AS BIGINT) AS n_bytes, min(TRY_CAST(regexp_extract(url, '{URL}', 3) AS INTEGER)) AS first, max(TRY_CAST(regexp_extract(url, '{URL}', 3) AS INTEGER)) AS last FROM pages WHERE regexp_extract(url, '{URL}', 2) <> '' GROUP BY 1")
def file_inventory(spark, sf):
    files = table(spark, sf, "pages").select(F.col("url").alias("path"), F.length("url").cast("bigint").alias("length"))
    return headers.inventory(files, r"^https?://[^/]+/([a-z]+)/([0-9]+)")


@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN l_returnflag = 'A' THEN (l_quantity - 32) * 5 / 9 ELSE l_quantity END, 6) AS celsius, l_tax * 25 / 100 AS fraction FROM lineitem")
def unit_conversions(spark, sf):
    li = table(spark, sf, "lineitem")
    conversion = F.when(F.col("l_returnflag") == "A", "F_to_C")
    return li.select("l_orderkey", "l_linenumber", F.round(C.fahrenheit(F.col("l_quantity"), conversion), 6).alias("celsius"), C.fraction(F.col("l_tax") * 25).alias("fraction"))


@query("SELECT o_orderkey, round(least(greatest(date_diff('day', DATE '1950-03-01' + CAST(o_custkey % 20000 AS INTEGER), CAST(o_orderdate AS DATE)) / 365.25, 0), 89), 1) AS age FROM orders")
def ages(spark, sf):
    born = F.date_add(F.to_date(F.lit("1950-03-01")), (F.col("o_custkey") % 20000).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", F.round(F.least(F.greatest(F.datediff(F.col("o_orderdate").cast("date"), born) / 365.25, F.lit(0.0)), F.lit(89.0)), 1).alias("age"))


@query("""SELECT l_orderkey, l_linenumber, name, value FROM (
 SELECT l_orderkey, l_linenumber, 'l_quantity' AS name, l_quantity AS value FROM lineitem UNION ALL
 SELECT l_orderkey, l_linenumber, 'l_discount', CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem) WHERE value IS NOT NULL""")
def wide_to_long(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax")
    return mapping.to_long(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("SELECT o_custkey, coalesce(min(o_totalprice) FILTER (o_orderstatus = 'F'), 0) AS F, coalesce(min(o_totalprice) FILTER (o_orderstatus = 'O'), 0) AS O, coalesce(min(o_totalprice) FILTER (o_orderstatus = 'P'), 0) AS P FROM orders GROUP BY 1")
def long_to_wide(spark, sf):
    return mapping.to_wide(table(spark, sf, "orders"), "o_custkey", "o_orderstatus", "o_totalprice", ["F", "O", "P"])


@query("SELECT p_partkey, CAST(CASE WHEN contains(p_name, 'ring') THEN 1 WHEN contains(p_name, 'small') THEN 2 WHEN contains(p_name, 'o') THEN 3 END AS INTEGER) AS var_id FROM part")
def substring_rules(spark, sf):
    return table(spark, sf, "part").select("p_partkey", mapping.first_rule(F.col("p_name"), [("ring", 1), ("small", 2), ("o", 3)]).alias("var_id"))


@query("""SELECT target, p_name, CAST(place AS INTEGER) AS place FROM (
 SELECT target, p_name, row_number() OVER (PARTITION BY target ORDER BY p_name) AS place FROM (SELECT DISTINCT p_name FROM part) JOIN (VALUES ('round', 'ring'), ('small', '^small'), ('either', 'blue|mint$'), ('none', 'zzzz')) AS t(target, pattern) ON regexp_matches(p_name, pattern)) WHERE place <= 10""")
def name_candidates(spark, sf):
    targets = spark.sql("SELECT * FROM VALUES ('round', 'ring'), ('small', '^small'), ('either', 'blue|mint$'), ('none', 'zzzz') AS t(target, pattern)")
    return mapping.candidates(table(spark, sf, "part").select("p_name").distinct(), targets, "p_name", "pattern", "target").select("target", "p_name", "place")


@query("SELECT l_orderkey, CAST(i - 1 AS INTEGER) AS place, parts[i] AS supp FROM (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS parts FROM lineitem GROUP BY 1), unnest(range(1, len(parts) + 1)) AS u(i)")
def list_rows(spark, sf):
    lists = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_suppkey")).alias("parts"))
    return mapping.list_rows(lists, "parts", "supp")


@query("SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1")
def first_per_key(spark, sf):
    return dedup.first_per(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_quantity", "l_extendedprice"]).select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")


PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high FROM part" for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))


@query(PROFILE)
def column_profile(spark, sf):
    return A.column_profile(table(spark, sf, "part")).drop("kind")


@query("SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS n FROM events GROUP BY 1")
def rows_per_year(spark, sf):
    return A.rows_per_year(raw_events(spark, sf), "time_ms")


@query("SELECT p_partkey, p_name, count FROM (SELECT l_partkey AS p_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, p_partkey LIMIT 30) LEFT JOIN part USING (p_partkey)")
def frequent_codes(spark, sf):
    return A.frequent(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey")), table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", 30)


@query("SELECT page_id, 'x' || page_id AS a, CASE WHEN page_id % 3 = 0 THEN 'one, two' WHEN page_id % 3 = 1 THEN 'q, r' ELSE 'plain' END AS note, CAST(page_id AS VARCHAR) AS b FROM pages")
def repaired_lines(spark, sf):
    p = table(spark, sf, "pages")
    note = F.when(F.col("page_id") % 3 == 0, '"one, two"').when(F.col("page_id") % 3 == 1, "q, r").otherwise("plain")
    lines = p.select(F.concat_ws(",", F.concat(F.lit("x"), F.col("page_id")), note, F.col("page_id")).alias("line"))
    return delimited.repair_lines(lines, "line", ["a", "note", "b"], fold_into=1).select(F.col("b").try_cast("bigint").alias("page_id"), "a", "note", "b")


@query("SELECT l_orderkey, l_linenumber, [CAST(l_quantity AS INTEGER), -CAST(l_quantity AS INTEGER), l_linenumber * 300] AS samples FROM lineitem")
def decoded_samples(spark, sf):
    """16-bit little-endian samples, written by arithmetic and read by the monitor decoder."""
    q = F.col("l_quantity").cast("int")

    def two_bytes(v):
        h = F.lpad(F.hex(F.pmod(v.cast("int"), F.lit(65536))), 4, "0")
        return F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2))

    data = F.unhex(F.concat(*(two_bytes(v) for v in (q, -q, F.col("l_linenumber") * 300))))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", monitors.little_endian_16(data).cast("array<int>").alias("samples"))


@query("SELECT 'page-' || page_id AS record, CAST(125 AS DOUBLE) AS fs, CAST(page_id * 10 AS BIGINT) AS n_samples, c AS channel FROM pages, (VALUES ('II'), ('PLETH')) AS v(c)")
def signal_headers(spark, sf):
    p = table(spark, sf, "pages")
    text = F.concat(F.lit("page-"), F.col("page_id"), F.lit(" 2 125 "), F.col("page_id") * 10, F.lit("\na.dat 80 1023 8 II\na.dat 80 10 8 PLETH\n# note\n"))
    return headers.channels(p.select(F.concat(F.lit("s/"), F.col("page_id"), F.lit(".hea")).alias("path"), text.alias("text"))).drop("path")


@query("SELECT 'm' || page_id AS path, CAST(place AS INTEGER) AS place, segment, CAST(n AS BIGINT) AS n_samples, CAST(first AS BIGINT) AS first_sample, segment = '~' AS is_gap FROM pages, LATERAL (VALUES (0, 'a', page_id, 0), (1, '~', 50, page_id), (2, 'b', 7, page_id + 50)) AS v(place, segment, n, first)")
def master_headers(spark, sf):
    p = table(spark, sf, "pages")
    text = F.concat(F.lit("m/3 1 125 99 10:00:00 01/01/2100\na "), F.col("page_id"), F.lit("\n~ 50\nb 7\n"))
    return headers.master_segments(p.select(F.concat(F.lit("m"), F.col("page_id")).alias("path"), text.alias("text"))).select("path", "place", "segment", "n_samples", "first_sample", "is_gap")


@query("SELECT c_custkey, 'DE' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS padded, CASE WHEN starts_with(c_name, 'Customer#') THEN substr(c_name, 10) ELSE c_name END AS bare, NULLIF(regexp_extract(c_name, '^([A-Za-z]+)#0*([0-9]+)$', 1), '') AS kind, NULLIF(regexp_extract(c_name, '^([A-Za-z]+)#0*([0-9]+)$', 2), '') AS number FROM customer")
def id_texts(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", C.padded_id(F.col("c_custkey"), 9, "DE").alias("padded"), C.without_prefix(F.col("c_name"), "Customer#").alias("bare"), *C.file_parts(F.col("c_name"), "^([A-Za-z]+)#0*([0-9]+)$", ["kind", "number"]))
