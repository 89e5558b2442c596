"""Thin queries over the corpus operators: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside.llm import oracles
from bedside.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def put(f):
        QUERIES[name] = f
        return f

    return put


@query("op5_bpe_round_trip")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import bpe

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.round_trip(docs, keep=["doc_id"])
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_chat_format")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import chat

    planted = spark.sql("SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text UNION ALL SELECT -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversations_read_back(turns.unionByName(planted))


ORACLES["op7_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(text)
    + (length(text) - length(replace(text, '\', '')))
    + (length(text) - length(replace(text, '<<SYS>>', ''))) // 7
    + (length(text) - length(replace(text, '<</SYS>>', ''))) // 8
    + (length(text) - length(replace(text, '[INST]', ''))) // 6
    + (length(text) - length(replace(text, '[/INST]', ''))) // 7
    + (length(text) - length(replace(text, '<s>', ''))) // 3
    + (length(text) - length(replace(text, '</s>', ''))) // 4
    + (length(text) - length(replace(text, '<<ROLE>>', ''))) // 8
    + (length(text) - length(replace(text, '<</ROLE>>', ''))) // 9
    + (length(text) - length(replace(text, '<</TURN>>', ''))) // 9
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 26 + length(role) END AS chars,
    lag(role) OVER w AS before, lead(role) OVER w AS after
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
                WHEN before = 'user' THEN role = 'assistant' ELSE false END
           AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM e GROUP BY conv_id
"""


@query("op2_mix_sources")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import mixing

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


@query("op10_top_k")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import topk

    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"))


ORACLES["op10_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import quality_rules

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = quality_rules.judge(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import classifier

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return classifier.score(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import token_counts

    return token_counts.with_limit(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_token_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import sstable

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sstable.read_shards(sstable.write_shards(docs, sstable.shard_folder(spark)))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_ngram_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import jaccard_join

    return jaccard_join.link_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"), n=3, threshold=90)


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import suffix_dedup

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.remove_repeats(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import packing

    pieces = packing.pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import repair

    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(turns, repair.damaged(turns))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bedside.llm import spelling

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(docs, spelling.planted)


ORACLES["op12_conversation_repair"] = oracles.repair_sql()
ORACLES["op13_spelling_variants"] = oracles.spelling_sql()

ORACLES["op9_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 90 * (max(x.n) + max(y.n) - count(*))
), reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
"""


ORACLES["op1_suffix_dedup"] = """
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), p AS (
  SELECT k, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM d, unnest(range(0, length(h) // 2 - 199)) AS u(i)
), r AS (SELECT k, i FROM p WHERE m IN (SELECT m FROM p GROUP BY m HAVING count(*) > 1)),
g AS (SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS run
  FROM (SELECT k, i, CASE WHEN i - lag(i) OVER (PARTITION BY k ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM r)),
s AS (SELECT k, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY k, run),
t AS (SELECT s.k, a, b, coalesce(lag(b) OVER (PARTITION BY s.k ORDER BY a), 0) AS before FROM s),
c AS (SELECT t.k, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM t JOIN d USING (k) GROUP BY t.k)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN c.k IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN c USING (k)
"""
