"""Conversation repair against all edit sequences and against a table of all prefixes."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from bedside.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
EMPTY = hashlib.sha256(b"").hexdigest()


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_edit(rows, most_inserts=2):
    """Least (cost, audit, repaired) over all edit sequences with few inserts; only for a handful of rows."""
    faults = faults_of(rows)
    best = None
    for letters in itertools.product("KUAD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, letters)):
            continue
        for places in itertools.product(range(most_inserts + 1), repeat=len(rows) + 1):
            if sum(places) > most_inserts:
                continue
            for names in itertools.product(("user", "assistant"), repeat=sum(places)):
                audit, said, cost, new = "", [], 0, iter(names)
                for i in range(len(rows) + 1):
                    for _ in range(places[i]):
                        audit, cost = audit + "I", cost + 5
                        said.append((next(new), ""))
                    if i == len(rows):
                        break
                    (role, text), e = rows[i], letters[i]
                    audit += "R" if e in "UA" else e
                    cost += {"K": 0, "U": 1, "A": 1, "D": 2}[e] + (5 if e != "D" and faults[i] == "truncated" else 0)
                    if e != "D":
                        said.append(({"K": role, "U": "user", "A": "assistant"}[e], text))
                if all(r for r, _ in said) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in said)):
                    found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in said))
                    best = min(best or found, found)
    return best


def by_prefixes(rows):
    """The same by a plain table over prefixes and states, for rows of any number."""
    faults = faults_of(rows)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def with_inserts(table):
        for _ in range(2):
            for state, (cost, audit, said) in list(table.items()):
                for name in ("user", "assistant"):
                    then = after.get((state, name[0]))
                    if then:
                        new = (cost + 5, audit + "I", [*said, f"{name}:"])
                        table[then] = min(table.get(then, new), new)
        return table

    table = with_inserts({"": (0, "", [])})
    for (role, text), fault in zip(rows, faults):
        new = {}

        def put(state, found):
            new[state] = min(new.get(state, found), found)

        for state, (cost, audit, said) in table.items():
            put(state, (cost + 2, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            for name, letter, price in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                then = after.get((state, name[:1]))
                if then:
                    put(then, (cost + price + more, audit + letter, [*said, f"{name}:{text}"]))
        table = with_inserts(new)
    cost, audit, said = min(table[s] for s in ("", "a") if s in table)
    return cost, audit, "\n".join(said)


def conversation(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", " "]
    texts = ["One.", "Two!", "cut", " ", "", "Three? ", "x.\n"] + [f"Said {i}." for i in range(n)]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_agenda_is_exhaustive():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4):
        for _ in range(25 if n < 4 else 10):
            rows = conversation(rng, n)
            marks = [(r[:1], {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}[f]) for (r, _), f in zip(rows, faults_of(rows))]
            cost, audit, _ = repair.derive(marks)
            assert (cost, audit, "\n".join(repair.replay(rows, audit))) == every_edit(rows) == by_prefixes(rows)


def damage(rows):
    """The planted faults, plainly."""
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(ids, rows):
    """One row per conversation; blocks of any length."""
    out = []
    for conv in ids:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in mine if t is not None}
        said = [(r, t) for _, r, t in mine]
        kinds = faults_of(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        cost, audit, text = by_prefixes(said)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def table(seed=1):
    rng = random.Random(seed)
    rows = [(c, t, r, x, "clash") for c in range(40) for t, (r, x) in enumerate(conversation(rng, rng.randrange(1, 12)))]
    rows += [(50, t, r, x, "clash") for t, (r, x) in enumerate(conversation(rng, 300))]
    rows += [(51, rng.randrange(9), "user", "Again.", None) for _ in range(120)]
    rows += [(52, None, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", "c", None]), None) for _ in range(60)]
    rows += [(None, 3, None, None, None), (None, None, "user", "Hi.", None), (None, 9, "assistant", "Ho.", None)]
    rows += [(60, 1, "user", "Only.", None), (61, None, None, None, None), (62, 2, "", "Nobody.", None)]
    return rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("most, block", [(1000, 500), (40, 7), (0, 3), (0, 1)])
def test_repair(spark, monkeypatch, most, block):
    """All conversations by one task each, some in blocks, all in blocks: the same rows."""
    monkeypatch.setattr(repair, "LONG_ROWS", most)
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rows = table()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ids = {r[0] for r in rows}
    assert rows_of(repair.repair(turns, repair.damaged(turns))) == expected(ids, damage(rows))


def test_long_texts_make_blocks_too(spark, monkeypatch):
    monkeypatch.setattr(repair, "LONG_CHARS", 300)
    rows = [(1, i, ("user", "assistant")[i % 2], "word " * (i % 90) + "end.") for i in range(60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(repair.repair(turns)) == expected({1}, rows)


def test_repaired_texts(spark, monkeypatch):
    monkeypatch.setattr(repair, "LONG_ROWS", 50)
    monkeypatch.setattr(repair, "BLOCK_ROWS", 9)
    rows = [r for r in table() if r[0] is not None]
    turns = spark.createDataFrame(rows, SCHEMA)
    whole = {r.conv_id: r.repaired_sha256 for r in repair.repair(turns).collect()}
    pieces = {}
    for r in sorted(repair.repaired_texts(turns).collect(), key=lambda r: (r.part, r.block)):
        pieces.setdefault(r.conv_id, []).append(r.said)
    assert {c: hashlib.sha256("\n".join(filter(None, p)).encode()).hexdigest() for c, p in pieces.items()} == whole


def test_dropped_and_empty(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    turns = spark.createDataFrame([(gone, 0, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    assert rows_of(repair.repair(turns, repair.damaged(turns))) == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    assert repair.repair(turns.where("false")).count() == 0


def test_query(spark, tmp_path):
    rows = [r[:4] for r in table(7)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert rows_of(got) == expected({r[0] for r in rows}, damage(rows))
