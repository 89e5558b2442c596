"""Chat formatting with a finite-state check of turn order and loss flags (operator 7), in built-in functions only.

A template states, per role, the strings that open and close a turn and whether its
text counts for the loss, and which role may follow which. Texts are escaped so that
no control string of the template occurs in them, and can be unescaped exactly.

A conversation may be as long as it likes: turns are gathered in chunks of
``CHUNK_TURNS`` positions. For the turn order each chunk becomes a function from
state to state, and those functions are applied in order, so no task ever needs a
whole conversation to check it.

Defined cases: a null text is empty; a null role is an empty one; an unknown role is
written with its name and makes the conversation invalid; rows of the same turn are
ordered by role, then text, and repeated rows stay; a null turn comes first; a null
conv_id is a conversation of its own; an empty table gives no rows. Columns beyond
the four named ones are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions of a conversation that are gathered in one row.
CHUNK_TURNS = 64
ESCAPE = "\\"


@dataclass(frozen=True)
class Role:
    """How one role's turns are written."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers and turn order. ``follows`` maps a state (a role, or "" for the start) to the roles that may come next."""

    roles: dict[str, Role] = field(default_factory=lambda: {"system": Role("<<SYS>>", "<</SYS>>"), "user": Role("[INST] ", " [/INST]"), "assistant": Role("<s>", "</s>", loss=True)})
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    accept: tuple[str, ...] = ("assistant",)
    other_open: str = "<<ROLE>>"
    other_name_close: str = "<</ROLE>>"
    other_close: str = "<</TURN>>"

    def controls(self) -> list[str]:
        marks = [m for r in self.roles.values() for m in (r.open, r.close)] + [self.other_open, self.other_name_close, self.other_close]
        return list(dict.fromkeys(m.strip() for m in marks))

    def check(self) -> None:
        """Control strings must not hold the escape character, each other, or overlap."""
        marks = self.controls()
        for a in marks:
            if len(a) < 2 or ESCAPE in a:
                raise ValueError(f"control string {a!r} is too short or holds the escape character")
            for b in marks:
                if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b) - 1)):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")


DEFAULT = Template()


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    """``text`` with doubled escape characters and one more inside each control string."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for m in template.controls():
        out = F.replace(out, F.lit(m), F.lit(m[0] + ESCAPE + m[1:]))
    return out


def unescaped(text: Column, template: Template = DEFAULT) -> Column:
    """The inverse of ``escaped``."""
    out = text
    for m in reversed(template.controls()):
        out = F.replace(out, F.lit(m[0] + ESCAPE + m[1:]), F.lit(m))
    return F.replace(out, F.lit(ESCAPE * 2), F.lit(ESCAPE))


def _segments(role: Column, text: Column, template: Template) -> Column:
    def part(piece: Column, loss: bool = False) -> Column:
        return F.struct(piece.alias("text"), F.lit(loss).alias("loss"))

    body = escaped(text, template)
    out = F.array(part(F.concat(F.lit(template.other_open), escaped(role, template), F.lit(template.other_name_close))), part(body), part(F.lit(template.other_close)))
    for name, r in template.roles.items():
        out = F.when(role == name, F.array(part(F.lit(r.open)), part(body, r.loss), part(F.lit(r.close)))).otherwise(out)
    return out


def _transitions(template: Template) -> tuple[list[str], list[str], list[int]]:
    """States (1 is the start, the last one is the error), roles, and the table of next states."""
    roles = list(template.roles)
    states = ["", *roles]
    bad = len(states) + 1
    table = [states.index(r) + 1 if r in template.follows.get(s, ()) else bad for s in states for r in [*roles, None]] + [bad] * (len(roles) + 1)
    return states, roles, table


def format_chunks(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation and chunk: conv_id, chunk, segments (text, loss) in order, and ``moves``, the state reached from each state."""
    template.check()
    states, roles, table = _transitions(template)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(
        "conv_id",
        F.floor(F.col("turn") / CHUNK_TURNS).alias("chunk"),
        F.struct("turn", role.alias("role"), text.alias("text"), _segments(role, text, template).alias("segments")).alias("row"),
    )
    grouped = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    kind = F.transform("rows", lambda r: _index(r["role"], roles))
    steps = F.array(*map(F.lit, table))
    width = len(roles) + 1
    moves = F.array(*(F.aggregate("kinds", F.lit(s), lambda s, k: F.element_at(steps, (s - 1) * width + k + 1)) for s in range(1, len(states) + 2)))
    return grouped.withColumn("kinds", kind).select("conv_id", "chunk", F.flatten(F.transform("rows", lambda r: r["segments"])).alias("segments"), moves.alias("moves"))


def _index(role: Column, roles: list[str]) -> Column:
    out = F.lit(len(roles))
    for i, name in enumerate(roles):
        out = F.when(role == name, i).otherwise(out)
    return out


def read_back(chunks: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Parse formatted chunks: conv_id, chunk, moves, turns (role, text), loss_text and formatted_chars."""
    marks = [(r.open, r.close) for r in template.roles.values()]
    one = "|".join([*(f"{_quoted(a)}.*?{_quoted(b)}" for a, b in marks), f"{_quoted(template.other_open)}.*?{_quoted(template.other_name_close)}.*?{_quoted(template.other_close)}"])

    def parse(t: Column) -> Column:
        a, b = template.other_open, template.other_name_close
        name_end = F.instr(t, b)
        name = F.substring(t, F.lit(len(a) + 1), name_end - len(a) - 1)
        body = F.substring(t, name_end + len(b), F.length(t) - name_end - len(b) + 1 - len(template.other_close))
        out = F.struct(unescaped(name, template).alias("role"), unescaped(body, template).alias("text"))
        for n, r in template.roles.items():
            text = F.substring(t, F.lit(len(r.open) + 1), F.length(t) - len(r.open) - len(r.close))
            out = F.when(F.startswith(t, F.lit(r.open)), F.struct(F.lit(n).alias("role"), unescaped(text, template).alias("text"))).otherwise(out)
        return out

    whole = chunks.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    return whole.select(
        "conv_id",
        "chunk",
        "moves",
        F.transform(F.regexp_extract_all("formatted", F.lit(f"(?s){one}"), F.lit(0)), parse).alias("turns"),
        unescaped(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""), template).alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _quoted(mark: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", mark)


def conversations_read_back(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Format, read back and digest whole conversations.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid.
    A digest needs a conversation's text in one value; it's gathered from chunks.
    """
    states, _, _ = _transitions(template)
    good = [states.index(s) + 1 for s in template.accept]
    per = read_back(format_chunks(turns, template), template).select(
        "conv_id",
        F.struct("chunk", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"), "loss_text", "moves").alias("part"),
        F.size("turns").cast("long").alias("n"),
        "formatted_chars",
    )
    whole = per.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("part")).alias("parts"), F.sum("formatted_chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("parts", lambda p: p["loss_text"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["said"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        F.aggregate("parts", F.lit(1), lambda s, p: F.element_at(p["moves"], s)).isin(good).alias("valid"),
    )
