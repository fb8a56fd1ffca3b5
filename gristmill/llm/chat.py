"""Chat formatting by a finite-state machine over roles, from a declarative template.

Everything is DataFrame functions: the turns of a conversation become one sorted array, the machine is a
fold over it, and the template turns it into segments, each with its loss flag. The formatted string is
their concatenation, and can be read back exactly: control strings inside texts are escaped.

Escaping: every control string begins with ``<|``. In a text, ``<``, any number of backslashes and ``|``
gets one backslash more, so a text never contains ``<|`` and taking one away again restores it. Roles
are written URL-encoded, which changes no usual role and keeps any other on one line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GUARD = "<|"


@dataclass(frozen=True)
class Template:
    """``{opening}role{after_role}text{closing}`` per turn; which roles bear loss; which may follow which."""

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    loss_roles: Sequence[str] = ("assistant",)
    start: str = "start"
    transitions: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    accepting: Sequence[str] = ("assistant",)

    def __post_init__(self) -> None:
        if not self.opening.startswith(GUARD) or not self.closing.startswith(GUARD):
            raise ValueError(f"control strings must begin with {GUARD}")
        if self.after_role != "\n":
            raise ValueError("the role's line must end with a line feed")
        if GUARD in self.opening[1:] or GUARD in self.closing[1:]:
            raise ValueError(f"a control string may hold {GUARD} only at its beginning")
        if self.opening.startswith(self.closing) or self.closing.startswith(self.opening):
            raise ValueError("control strings must differ")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_conversations(
    turns: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(conv_id, n_turns, valid, error_turn, segments, formatted)`` per conversation.

    Turns are ordered by number, then role, then text, nulls first; numbers may have gaps, and repeated
    rows are repeated turns. A null text or role is empty. ``segments`` is an array of
    ``(role, text, loss, control)``. The machine accepts a conversation if every role may follow the one
    before and the last state is accepting; ``error_turn`` is the index of the first turn it refuses, or
    the number of turns if it only ends too early. Refused conversations are formatted all the same. Rows
    without a conversation id belong to none and are left out; an empty table gives no rows.
    """
    row = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).alias("conv_id"), row.alias("row"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    state = _machine(template, F.transform("turns", lambda t: t["role"]))
    n_turns = F.size("turns").cast("long")
    early = F.when(~state["state"].isin(list(template.accepting)), n_turns)
    run = whole.select("conv_id", "turns", n_turns.alias("n_turns"), F.coalesce(state["error"], early).alias("error_turn"))
    segments = F.flatten(F.transform("turns", lambda t: _segments(template, t)))
    made = run.select("conv_id", "n_turns", F.col("error_turn").isNull().alias("valid"), "error_turn", segments.alias("segments"))
    return made.withColumn("formatted", F.concat_ws("", F.transform("segments", lambda s: s["text"])))


def _machine(template: Template, roles: Column) -> Column:
    """``(state, place, error)`` after all roles; a refused role leaves the state as it is."""
    edges = [F.lit(part) for state, following in template.transitions.items() for role in following for part in (f"{state}>{role}", role)]
    table = F.create_map(*edges)
    start = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("long").alias("error")
    )

    def step(at: Column, role: Column) -> Column:
        following = F.try_element_at(table, F.concat(at["state"], F.lit(">"), role))
        error = F.coalesce(at["error"], F.when(following.isNull(), at["place"]))
        return F.struct(
            F.coalesce(following, at["state"]).alias("state"), (at["place"] + 1).alias("place"), error.alias("error")
        )

    return F.aggregate(roles, start, step)


def _segments(template: Template, turn: Column) -> Column:
    def segment(text: Column, loss: Column, control: bool) -> Column:
        return F.struct(turn["role"].alias("role"), text.alias("text"), loss.alias("loss"), F.lit(control).alias("control"))

    opening = F.concat(F.lit(template.opening), F.url_encode(turn["role"]), F.lit(template.after_role))
    loss = turn["role"].isin(list(template.loss_roles))
    return F.array(
        segment(opening, F.lit(False), True),
        segment(escaped(turn["text"]), loss, False),
        segment(F.lit(template.closing), F.lit(False), True),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted string as an array of ``(role, text)``."""
    parts = F.split(formatted, _literal(template.opening), -1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.after_role, 1)
        begin = F.char_length(role) + len(template.after_role)
        size = F.char_length(part) - begin - len(template.closing)
        text = part.substr(begin + 1, size)
        return F.struct(F.url_decode(role).alias("role"), unescaped(text).alias("text"))

    # Nothing stands before the first opening.
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])))
