"""Repairing the structure of conversations by a lightest derivation (operator 12).

A conversation is sound if its role initials read ``(s?(ua)+)?``. Its rows are read in order; each
may be kept (K, cost 0), given the role user or assistant (R, 1) or deleted (D, 2), and empty user or
assistant rows may be inserted anywhere (I, 5). Blank rows and repetitions must be deleted; a truncated
row that stays costs 5 more. Wanted is the edit sequence of least cost, and of those the least in ASCII.

Items are "the first i rows are read and the output is in state q". A deduction combines an item with
an edit of row i, or inserts a row; its weight (cost, audit) is no less than the item's and rises with it: where
as many rows are read at one cost, two audits differ before either ends, so a letter more keeps
their order. The agenda pops items in that order, each finally, until the goal is popped (Knuth).

Conversations of at most ``LONG_ROWS`` rows and ``LONG_CHARS`` characters are read by one task
each, many per task. A longer one is spread over tasks:

1. equal rows are counted, and the first of each role and text is marked by grouping on unique keys;
2. rows are ranged over tasks by conversation and place and cut into blocks; a block gives, from
   each state to each state, its least cost;
3. one row per block suffices to find the least cost to go from each block's end on;
4. each block derives its least audit for each state before it, with that cost to go as the weight of its last
   deduction, and the state it ends in;
5. those functions are chained, and the parts on the chain are the result. Only the audit itself and the
   digest, values of one row, gather what the longest conversation puts out.

Defined cases: nulls of role and text are one space; a null conv_id is a conversation; rows are ordered by turn
(nulls first), role and text; the initial of an empty role fits nowhere; rows of any number may repeat; an
empty table gives no rows; columns beyond the four named ones are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterable, Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedside.llm.common import remove_written, written

LONG_ROWS = 1_000
LONG_CHARS = 4_000_000
#: Rows in a block of a long conversation; equal rows count once.
BLOCK_ROWS = 500
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the output: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (START, ASSISTANT)
NEXT = {"s": (START,), "u": (START, SYSTEM, ASSISTANT), "a": (USER,)}
REACHED = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
SOUND_PAIRS = ("su", "ua", "au")
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)
FAR = 1 << 60
FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

_no_word = re.compile(r"[^\x20\x09-\x0D]")
_full_stop = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")


def fault_of(role: str, text: str, seen: set[tuple[str, str]]) -> int:
    """The first fault of a row; ``seen`` holds the rows before and gets this one."""
    known = (role, text) in seen
    seen.add((role, text))
    if not _no_word.search(text):
        return BLANK
    if known:
        return DUPLICATE
    return FINE if _full_stop.search(text) else CUT_OFF


def edits(initial: str, fault: int, state: int) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and next state of each edit of a row that is read in ``state``."""
    yield DELETE, "D", state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault == CUT_OFF else 0
    if state in NEXT.get(initial, ()):
        yield KEEP + more, "K", REACHED[initial]
    yield REROLE + more, "R", turn_after(state)


def turn_after(state: int) -> int:
    """The state after a user or assistant row that may follow ``state``; there is exactly one."""
    return ASSISTANT if state == USER else USER


def derivations(
    rows: list[tuple[str, int]], start: int = START, ahead: dict[int, int] | None = None, last: bool = True
) -> Iterator[tuple[int, str, int]]:
    """Cost, audit and end state of the goals over rows (initial, fault), by an agenda: the lightest one first.

    ``ahead`` is the weight of the goal's deduction from each end state (default: 0 from the accepted ones).
    Unless ``last``, rows are inserted before rows only: an insertion at a block's end belongs to the next.
    """
    ahead = dict.fromkeys(ACCEPTED, 0) if ahead is None else ahead
    n, goal = len(rows), len(rows) + 1
    done: set[tuple[int, int]] = set()
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == goal:
            yield cost, audit, state
            continue
        if at == n and ahead.get(state, FAR) < FAR:
            heapq.heappush(agenda, (cost + ahead[state], audit, goal, state))
        if at < n:
            for more, letter, then in edits(*rows[at], state):
                if (at + 1, then) not in done:
                    heapq.heappush(agenda, (cost + more, audit + letter, at + 1, then))
        if (at < n or last) and (at, turn_after(state)) not in done:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", at, turn_after(state)))


def derive(rows: list[tuple[str, int]], *how, **more) -> tuple[int, str, int] | None:
    """The lightest derivation."""
    return next(derivations(rows, *how, **more), None)


def replay(rows: Iterable[tuple[str, str]], audit: str, state: int = START) -> Iterator[str]:
    """``role:text`` of the rows that an audit leaves, in order."""
    left = iter(rows)
    for letter in audit:
        if letter == "I":
            state = turn_after(state)
            yield f"{NAMES[state]}:"
            continue
        role, text = next(left)
        if letter == "R":
            state = turn_after(state)
            yield f"{NAMES[state]}:{text}"
        elif letter == "K":
            state = REACHED[role[0]]
            yield f"{role}:{text}"


def whole(rows: list[tuple[int | None, str, str]]) -> tuple[int, int, int, int, int, int, str, str]:
    """Gaps, blank, duplicate, truncated, illegal, cost, audit and repaired text of one conversation's (turn, role, text) rows."""
    seen: set[tuple[str, str]] = set()
    turns = {turn for turn, _, _ in rows if turn is not None}
    faults = [fault_of(role, text, seen) for _, role, text in rows]
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in SOUND_PAIRS for a, b in itertools.pairwise(initials))
    cost, audit, _ = derive(list(zip(initials, faults)))
    said = "\n".join(replay([(role, text) for _, role, text in rows], audit))
    lacking = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return lacking, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT_OFF), illegal, cost, audit, said


def clean_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with nulls of the last two as one space."""
    return turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with planted faults, by the checksum of ``conv_id:turn`` (nulls: one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its full stops, 3 repeats it, 4 makes it the user's.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = clean_rows(turns).withColumn("kind", F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    rows = rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def long_conversations(rows: DataFrame) -> DataFrame:
    """conv_id of those that one task shall not hold."""
    size = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    return size.where((F.col("n") > LONG_ROWS) | (F.col("chars") > LONG_CHARS)).select("conv_id")


def _row_stream(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[n].to_pylist() for n in names))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """A record batch of rows under a schema of plain columns."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(c.split(" ") for c in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def short_repaired(rows: DataFrame, with_texts: bool = False) -> DataFrame:
    """The results of conversations that a task can hold, and on demand their repaired texts (``said``)."""
    schema = f"conv_id long, {FOUND}" + (", said string" if with_texts else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        stream = _row_stream(batches, "conv_id", "turn", "role", "text")
        for conv, group in itertools.groupby(stream, key=itemgetter(0)):
            *found, said = whole([row[1:] for row in group])
            out.append((conv, *found, _digest(said), *([said] if with_texts else [])))
            held += len(found[-1]) + 100 + (len(said) if with_texts else 0)
            if held > LONG_CHARS:
                yield _batch(out, schema)
                out, held = [], 0
        yield _batch(out, schema)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.mapInArrow(run, schema)


def gaps(rows: DataFrame) -> DataFrame:
    """conv_id and the number of turns that lack between its first and its last one."""
    turns = rows.where("turn IS NOT NULL").select("conv_id", "turn").distinct()
    return turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))


# Long conversations


def marked_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number ``n`` and whether they are the first of their role and text (``first``).

    Both are groupings with partial sums; they meet on a key that no two rows share.
    """
    key = ["conv_id", "turn", "role", "text"]
    counted = rows.groupBy(*key).agg(F.count("*").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = rows.groupBy("conv_id", "role", "text").agg(F.min(place).alias("place"))
    heads = first.select("conv_id", F.col("place.turn").alias("turn"), "role", "text", F.lit(0).cast("long").alias("n"))
    both = counted.withColumn("first", F.lit(False)).unionByName(heads.withColumn("first", F.lit(True)))
    return both.groupBy(*key).agg(F.sum("n").alias("n"), F.max("first").alias("first"))


def blocks(marked: DataFrame) -> DataFrame:
    """Blocks of rows in order: conv_id, part and block (their order), and role, text, n and fault of the rows."""
    word, stop = F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(~word, BLANK).when(~F.col("first"), DUPLICATE).when(stop, FINE).otherwise(CUT_OFF)
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = marked.withColumn("fault", fault).repartitionByRange(*order).sortWithinPartitions(*order)
    row = "array<struct<role:string,text:string,n:long,fault:int>>"
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("n", pa.int64()), ("fault", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        conv, held, chars = None, [], 0

        def block() -> pa.RecordBatch:
            head = _batch([(conv, part, number)], "conv_id long, part int, block long")
            rows = [dict(zip(("role", "text", "n", "fault"), r)) for r in held]
            return head.append_column("rows", pa.array([rows], kind))

        for row in _row_stream(batches, "conv_id", "role", "text", "n", "fault"):
            if held and (row[0] != conv or len(held) >= BLOCK_ROWS or chars > LONG_CHARS):
                yield block()
                held, chars, number = [], 0, number + 1
            conv = row[0]
            held.append(row[1:])
            chars += len(row[2])
        if held:
            yield block()

    made = ranged.select("conv_id", "role", "text", "n", "fault")
    return made.mapInArrow(run, f"conv_id long, part int, block long, rows {row}")


def _unfolded(rows: list[dict]) -> tuple[list[tuple[str, str]], list[tuple[str, int]], list[int]]:
    """Rows of a block with the repetitions of one as a single row: (role, text), (initial, fault), and how often each stands."""
    said, marks, counts = [], [], []
    for r in rows:
        sound = r["fault"] in (FINE, CUT_OFF)
        for fault, n in [(r["fault"], 1), (DUPLICATE, r["n"] - 1)] if sound else [(r["fault"], r["n"])]:
            if n:
                said.append((r["role"], r["text"]))
                marks.append((r["role"][:1], fault))
                counts.append(n)
    return said, marks, counts


def block_costs(parts: DataFrame) -> DataFrame:
    """Per block its counts of faults, of illegal pairs inside, its first and last initial, and least costs from state to state."""
    schema = (
        "conv_id long, part int, block long, blank long, duplicate long, truncated long, illegal long, "
        "head string, tail string, costs array<long>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, part, number, rows in _row_stream([batch], "conv_id", "part", "block", "rows"):
                _, marks, counts = _unfolded(rows)
                # A repetition costs the same in every derivation: the further ones are added afterwards.
                more = DELETE * (sum(counts) - len(counts))
                costs = []
                for a in STATES:
                    ends = {s: c for c, _, s in derivations(marks, a, dict.fromkeys(STATES, 0), last=False)}
                    costs += [ends[s] + more if s in ends else FAR for s in STATES]
                have = [sum(n for (_, f), n in zip(marks, counts) if f == kind) for kind in (BLANK, DUPLICATE, CUT_OFF)]
                wrong = sum(a + b not in SOUND_PAIRS for (a, _), (b, _) in itertools.pairwise(marks))
                wrong += sum(counts) - len(counts)
                out.append((conv, part, number, *have, wrong, marks[0][0], marks[-1][0], costs))
            yield _batch(out, schema)

    return parts.mapInArrow(run, schema)


def costs_to_go(costs: DataFrame) -> DataFrame:
    """Per block the least costs from each state before it (``here``) and after it (``ahead``) to the conversation's end.

    A conversation's blocks are read backwards by one task, which holds four numbers.
    """
    schema = "conv_id long, part int, block long, is_last boolean, here array<long>, ahead array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, here = (), []
        for batch in batches:
            out = []
            for c, part, number, cost in _row_stream([batch], "conv_id", "part", "block", "costs"):
                is_last = conv != (c,)
                # At the very end rows may still be inserted.
                ahead = [derive([], s)[0] for s in STATES] if is_last else here
                here = [min(FAR, *(cost[4 * a + b] + ahead[b] for b in STATES)) for a in STATES]
                conv = (c,)
                out.append((c, part, number, is_last, here, ahead))
            yield _batch(out, schema)

    back = costs.select("conv_id", "part", "block", "costs").repartition("conv_id")
    return back.sortWithinPartitions("conv_id", F.desc("part"), F.desc("block")).mapInArrow(run, schema)


def block_audits(parts: DataFrame, ahead: DataFrame) -> DataFrame:
    """Per block and state before it: its part of the audit (``edits``), the rows that it leaves (``said``), the state after it."""
    schema = "conv_id long, part int, block long, before int, after int, edits string, said string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, part, number, rows, is_last, ahead in _row_stream([batch], *names):
                said, marks, counts = _unfolded(rows)
                for a in STATES:
                    found = derive(marks, a) if is_last else derive(marks, a, dict(enumerate(ahead)), last=False)
                    if found is not None:
                        _, audit, after = found
                        often = iter(counts)
                        letters = "".join(e if e == "I" else e * next(often) for e in audit)
                        out.append((conv, part, number, a, after, letters, "\n".join(replay(said, audit, a))))
            yield _batch(out, schema)

    names = ["conv_id", "part", "block", "rows", "is_last", "ahead"]
    return parts.join(ahead.drop("conv_id"), ["part", "block"]).select(*names).mapInArrow(run, schema)


def on_path(audits: DataFrame) -> DataFrame:
    """The part and block of each row of ``audits`` that lies on its conversation's path, with the state before."""
    schema = "part int, block long, before int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = (), START
        for batch in batches:
            out = []
            for c, part, number, moves in _row_stream([batch], "conv_id", "part", "block", "moves"):
                state = START if conv != (c,) else state
                conv = (c,)
                out.append((part, number, state))
                state = next(m["after"] for m in moves if m["before"] == state)
            yield _batch(out, schema)

    # At most four rows a block.
    moves = audits.groupBy("conv_id", "part", "block").agg(F.collect_list(F.struct("before", "after")).alias("moves"))
    return moves.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(run, schema)


def joined_pieces(taken: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 from the blocks on the path; texts stream through their digest."""
    schema = "conv_id long, audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _row_stream(batches, "conv_id", "edits", "said")
        for conv, group in itertools.groupby(stream, key=itemgetter(0)):
            audit, digest, begun = [], hashlib.sha256(), False
            for _, edits_here, said in group:
                audit.append(edits_here)
                if said:
                    digest.update(b"\n" * begun + said.encode())
                    begun = True
            yield _batch([(conv, "".join(audit), digest.hexdigest())], schema)

    rows = taken.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return rows.select("conv_id", "edits", "said").mapInArrow(run, schema)


def long_pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Costs by block, and the blocks on the path (conv_id, part, block, edits, said), of long conversations."""
    parts = written(blocks(marked_rows(rows)), "repair-blocks")
    costs = written(block_costs(parts), "repair-costs")
    audits = written(block_audits(parts, costs_to_go(costs)), "repair-audits")
    remove_written(parts)
    return costs, audits.join(on_path(audits), ["part", "block", "before"], "left_semi")


def long_repaired(rows: DataFrame) -> DataFrame:
    """As ``short_repaired``, for conversations of any length; each of its rows has some of the columns."""
    costs, taken = long_pieces(rows)
    before = F.lag("tail").over(Window.partitionBy("conv_id").orderBy("part", "block"))
    seam = F.when(F.concat(before, "head").isin(*SOUND_PAIRS), 0).when(before.isNotNull(), 1).otherwise(0)
    counts = costs.withColumn("illegal", F.col("illegal") + seam).groupBy("conv_id")
    counts = counts.agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    first = F.min_by("here", F.struct("part", "block"))
    cost = costs_to_go(costs).groupBy("conv_id").agg(F.element_at(first, START + 1).alias("cost"))
    out = counts
    for more in (cost, joined_pieces(taken), gaps(rows)):
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def repair(turns: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per conv_id of ``turns``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` are those to repair where they aren't ``turns`` themselves.
    """
    rows = clean_rows(turns) if rows is None else rows
    ids = turns.select(F.col("conv_id").cast("long")).distinct()
    long = written(long_conversations(rows), "repair-long")
    if long.isEmpty():
        found = short_repaired(rows)
    else:
        same = rows["conv_id"].eqNullSafe(long["conv_id"])
        found = short_repaired(rows.join(long, same, "left_anti"))
        found = found.unionByName(long_repaired(rows.join(long, same, "left_semi")), allowMissingColumns=True)
    both = ids.unionByName(found, allowMissingColumns=True).groupBy("conv_id")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return both.agg(
        *(F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in numbers),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def repaired_texts(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, part, block (the order of the pieces of a long one) and said, rows ``role:text``."""
    rows = clean_rows(turns)
    long = written(long_conversations(rows), "repair-long")
    same = rows["conv_id"].eqNullSafe(long["conv_id"])
    short = short_repaired(rows.join(long, same, "left_anti"), with_texts=True)
    short = short.select("conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("block"), "said")
    _, taken = long_pieces(rows.join(long, same, "left_semi"))
    return short.unionByName(taken.select("conv_id", "part", "block", "said"))
