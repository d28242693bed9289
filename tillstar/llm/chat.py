"""Chat formatting by a finite-state machine over roles. DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How a role is written: what stands before and after its text, and if the text is learnt."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Marks per role and the allowed order of roles.

    ``other`` (before the role's name, before the text, after it) writes roles without marks of
    their own. ``moves`` maps state -> role -> next state; a conversation is valid if it starts in
    ``start``, every turn has a move and it ends in one of ``ends``.

    Marks are the control strings. Inside texts a backslash goes in after a mark's first character,
    and backslashes are doubled. As no mark holds another mark's first character further in, a
    mark in the output is always a real one.
    """

    roles: dict[str, Turn]
    other: tuple[str, str, str]
    moves: dict[str, dict[str, str]]
    start: str
    ends: tuple[str, ...]
    escape: str = field(default="\\", init=False)

    def __post_init__(self):
        firsts = {m[0] for m in self.marks}
        if any(len(m) < 2 or self.escape in m or firsts & set(m[1:]) for m in self.marks):
            raise ValueError("a mark's first character may not occur inside another mark")
        openers = [t.before for t in self.roles.values()] + [self.other[0]]
        if len(set(openers)) < len(openers):
            raise ValueError("roles need different marks")

    @property
    def marks(self) -> list[str]:
        own = [m for t in self.roles.values() for m in (t.before, t.after)]
        return sorted({*own, *self.other})


INSTRUCT = ChatTemplate(
    roles={
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    other=("[ROLE]", "[TEXT]", "[/TEXT]"),
    moves={
        "start": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    start="start",
    ends=("answered",),
)


def escaped(text: Column, template: ChatTemplate) -> Column:
    inside = "|".join(
        f"(?<={re.escape(m[0])})(?={re.escape(m[1:])})" for m in template.marks
    )
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), inside, r"\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _segments(turn: Column, template: ChatTemplate) -> Column:
    """Marks and text of one turn as segments with their loss flags."""
    role, text = turn["role"], escaped(turn["text"], template)

    def segments(*parts: tuple[Column, bool]) -> Column:
        return F.array(*[F.struct(p.alias("text"), F.lit(x).alias("loss")) for p, x in parts])

    name, start, end = template.other
    out = segments(
        (F.concat(F.lit(name), escaped(role, template), F.lit(start)), False),
        (text, False), (F.lit(end), False),
    )
    for own, marks in template.roles.items():
        out = F.when(
            role == own,
            segments((F.lit(marks.before), False), (text, marks.loss), (F.lit(marks.after), False)),
        ).otherwise(out)
    return out


def _end_state(roles: Column, template: ChatTemplate) -> Column:
    pairs = [
        F.lit(x) for state, by_role in template.moves.items()
        for role, to in by_role.items() for x in (f"{state}>{role}", to)
    ]
    moves = F.create_map(*pairs)
    return F.aggregate(
        roles, F.lit(template.start),
        lambda state, role: F.coalesce(
            F.try_element_at(moves, F.concat(state, F.lit(">"), role)), F.lit("stuck")
        ),
    )


def format_conversations(turns: DataFrame, template: ChatTemplate = INSTRUCT) -> DataFrame:
    """``conv_id, n_turns, is_valid, segments, formatted`` of conversations given as turns.

    Turns are put in order of ``turn`` (null first; ties by role, then text; repeated rows stay).
    Null role or text counts as empty. All turns are written, in valid order or not; ``is_valid``
    tells what the machine says. Rows with a null ``conv_id`` form one conversation. No turns, no
    rows. A conversation's output is one string, so its turns meet in one group by nature.
    """
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    formatted = grouped.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        _end_state(F.transform("_turns", lambda t: t["role"]), template)
        .isin(*template.ends).alias("is_valid"),
        F.flatten(F.transform("_turns", lambda t: _segments(t, template))).alias("segments"),
    )
    return formatted.withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def turns_of(formatted: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """Roles and texts read back from a formatted string, in order."""
    name, start, end = template.other
    openers = [t.before for t in template.roles.values()] + [name]
    pieces = F.split(formatted, "|".join(f"(?={re.escape(m)})" for m in openers))

    def between(piece: Column, before: Column | str, after: str) -> Column:
        head = F.char_length(before) if isinstance(before, Column) else F.lit(len(before))
        size = F.char_length(piece) - head - len(after)
        return unescaped(F.substr(piece, head + 1, size))

    def read(piece: Column) -> Column:
        head = F.substring_index(piece, start, 1)
        out = F.struct(
            unescaped(F.substr(head, F.lit(len(name) + 1))).alias("role"),
            between(piece, F.concat(head, F.lit(start)), end).alias("text"),
        )
        for role, marks in template.roles.items():
            known = F.struct(
                F.lit(role).alias("role"), between(piece, marks.before, marks.after).alias("text")
            )
            out = F.when(F.startswith(piece, F.lit(marks.before)), known).otherwise(out)
        return out

    return F.transform(pieces, read)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    learnt = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learnt, lambda s: unescaped(s["text"])), "")
