"""DuckDB SQL of operators whose oracles are composed of repeated parts."""

from __future__ import annotations


def crc32_sql(key: str) -> str:
    """The unsigned CRC-32 of an expression's UTF-8 bytes, bit by bit."""
    octets = f"list_transform(range(0, octet_length(encode({key}))), lambda i: CAST('0x' || substr(hex(encode({key})), 2 * i + 1, 2) AS BIGINT))"
    steps = f"flatten(list_transform({octets}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    turn = "xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE {turn} END), 4294967295)"


def _least(*candidates: str) -> str:
    """The least struct, nulls aside."""
    return f"list_sort(list_filter([{', '.join(candidates)}], lambda z: z IS NOT NULL))[1]"


def _more(state: str, cost: str, letter: str, said: str | None = None, given: str = "true") -> str:
    text = f"{state}.s" if said is None else f"{state}.s || chr(10) || {said}"
    return f"CASE WHEN {state} IS NOT NULL AND {given} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 's': {text}}} END"


def repair_sql() -> str:
    """Rows are folded over the least (cost, audit, text) of each of four output states: none, system, user, assistant."""
    old = [f"x.st[{i}]" for i in (1, 2, 3, 4)]
    user = _least(old[2], *(_more(old[q], "5", "I", "'user:'") for q in (0, 1, 3)))
    assistant = _least(old[3], _more(old[2], "5", "I", "'assistant:'"))
    inserted = f"[{old[0]}, {old[1]}, {user}, {assistant}]"
    st = [f"t[{i}]" for i in (1, 2, 3, 4)]
    stays = "y.fault NOT IN ('blank', 'duplicate')"
    late = "(CASE WHEN y.fault = 'truncated' THEN 5 ELSE 0 END)"

    def kept(state: str, initial: str) -> str:
        return _more(state, late, "K", "y.role || ':' || y.text", f"{stays} AND y.role[1] = '{initial}'")

    def named(state: str, name: str) -> str:
        return _more(state, f"{late} + 1", "R", f"'{name}:' || y.text", stays)

    def gone(state: str) -> str:
        return _more(state, "2", "D")

    step = [
        gone(st[0]),
        _least(gone(st[1]), kept(st[0], "s")),
        _least(gone(st[2]), *(f(st[q], n) for q in (0, 1, 3) for f, n in ((kept, "u"), (named, "user")))),
        _least(gone(st[3]), kept(st[2], "a"), named(st[2], "assistant")),
    ]
    read = f"list_transform([{inserted}], lambda t: [{', '.join(step)}])[1]"
    row = "{'role': role, 'text': text, 'fault': fault, 'st': CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, s VARCHAR)[])}"
    begin = "{'role': '', 'text': '', 'fault': '', 'st': [{'c': CAST(0 AS BIGINT), 'a': '', 's': ''}, NULL, NULL, NULL]}"
    fold = f"list_reduce(list_prepend({begin}, rows), lambda x, y: {{'role': '', 'text': '', 'fault': '', 'st': {read}}})"
    last = f"list_transform([{fold}], lambda x: {_least(old[0], old[3], _more(old[2], '5', 'I', repr('assistant:')))})[1]"
    named_key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    blank = r"'[\x20\x09-\x0D]'"
    return f"""
WITH k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(named_key)} % 20 AS kind
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k WHERE kind <> 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d
), f AS (
  SELECT *, regexp_replace(text, {blank}, '', 'g') AS words,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
    lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM n
), g AS (
  SELECT *, CASE WHEN words = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(words, 1) IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault
  FROM f
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal,
    list({row} ORDER BY i) AS rows
  FROM g GROUP BY conv_id
), r AS (SELECT * EXCLUDE (rows), {last} AS best FROM c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
  coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.s, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
"""


def spelling_sql() -> str:
    """Near words agree after one place is masked in both, or removed from one."""
    runs = "list_filter(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+'), lambda w: length(w) >= 7)"
    folded = f"list_transform({runs}, lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
    key = "coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w"
    return f"""
WITH RECURSIVE u AS (SELECT doc_id, unnest({folded}) AS w FROM documents),
d AS (SELECT doc_id, w, count(*) AS n FROM u GROUP BY doc_id, w),
h AS (SELECT w, n, {crc32_sql(key)} AS h FROM d),
a AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM a WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
m AS (SELECT word, n, left(word, i - 1) || '*' || substr(word, i + 1) AS masked, left(word, i - 1) || substr(word, i + 1) AS less FROM p),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM m x JOIN m y ON x.masked = y.masked AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM m x JOIN v y ON x.less = y.word
  UNION SELECT y.word, x.word, x.n FROM m x JOIN v y ON x.less = y.word
), r AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS nth FROM near
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form,
    CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN r ON r.word = v.word AND nth = 1
), roots AS (
  SELECT word, word AS root FROM f WHERE form IS NULL
  UNION ALL SELECT f.word, roots.root FROM f JOIN roots ON f.form = roots.word
)
SELECT f.*, root FROM f JOIN roots USING (word)
"""
