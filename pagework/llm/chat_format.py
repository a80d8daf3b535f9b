"""Chat formatting with a finite-state machine over roles and a declarative template, in DataFrame functions only.

The template names, for each role, the strings around a turn's text and whether the text counts for
the loss, and the allowed steps from role to role. A conversation becomes text segments with loss
flags. Control strings inside texts are escaped: backslashes double, and a control string gets a
backslash behind its first character; dropping the backslash of every pair undoes both.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagework.llm.common import quoted

START = "start"


@dataclass(frozen=True)
class Role:
    name: str
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``steps``: role (or "start") -> the roles that may follow it; ``ends``: those that may be last.

    Roles that the template does not know stand between ``other[0]`` and ``other[1]``, their text
    before ``other[2]``; they make a conversation invalid but are kept.
    """

    roles: tuple[Role, ...]
    steps: dict[str, tuple[str, ...]] = field(hash=False)
    ends: tuple[str, ...] = ()
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")

    def controls(self) -> list[str]:
        """All control strings, longest first, without the white space around them."""
        found = {s.strip() for r in self.roles for s in (r.before, r.after)} | set(self.other)
        return sorted(found - {""}, key=lambda s: (-len(s), s))


INSTRUCT = Template(
    roles=(
        Role("system", "<s><<SYS>>", "<</SYS>>"),
        Role("user", "[INST] ", " [/INST]"),
        Role("assistant", "[ANS] ", "</s>", loss=True),
    ),
    steps={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)


def escaped(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls():
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _case(role: Column, pairs: list[tuple[str, Column]], otherwise: Column) -> Column:
    out = F.when(F.lit(False), otherwise)
    for name, value in pairs:
        out = out.when(role == name, value)
    return out.otherwise(otherwise)


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    template: Template = INSTRUCT,
) -> DataFrame:
    """One row per conversation: ``conv_col, segments`` (array of text and loss), ``formatted`` (all
    segments in one text), ``valid`` (the turn order is one the machine accepts).

    Turns are ordered by number (null first), role and text, so ties and repeated rows have one
    order. Null texts and null roles are empty; rows with a null conversation form one. A role the
    template does not know is written out. Invalid conversations are formatted as well. An empty
    table gives no rows; other columns are ignored. A conversation is one row, since its text is
    one value.
    """
    role = F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit(""))
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    before = _case(role, [(r.name, F.lit(r.before)) for r in template.roles],
                   F.concat(F.lit(template.other[0]), escaped(role, template), F.lit(template.other[1])))
    after = _case(role, [(r.name, F.lit(r.after)) for r in template.roles], F.lit(template.other[2]))
    loss = _case(role, [(r.name, F.lit(r.loss)) for r in template.roles], F.lit(False))
    rows = turns.select(
        F.col(quoted(conv_col)).alias("conv"),
        F.struct(
            F.col(quoted(turn_col)).alias("turn"), role.alias("role"), text.alias("text"), before.alias("before"),
            escaped(text, template).alias("inside"), after.alias("after"), loss.alias("loss"),
        ).alias("t"),
    )
    gathered = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(t["before"].alias("text"), F.lit(False).alias("loss")),
        F.struct(t["inside"].alias("text"), t["loss"].alias("loss")),
        F.struct(t["after"].alias("text"), F.lit(False).alias("loss")),
    )))
    # The machine: a state per turn, null once a step is not allowed.
    state = F.aggregate("turns", F.lit(START), lambda s, t: F.when(
        F.concat_ws(">", s, t["role"]).isin(*[f"{a}>{b}" for a, to in template.steps.items() for b in to]) & s.isNotNull(), t["role"]))
    laid = gathered.select(F.col("conv").alias(conv_col), segments.alias("segments"), state.isin(*template.ends).alias("valid"))
    return laid.select(
        conv_col, "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.coalesce("valid", F.lit(False)).alias("valid"),
    )


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns of a formatted conversation again: array of ``role, text``."""
    def literal(s: str) -> str:
        return "".join(c if c.isalnum() or c == " " else "\\" + c for c in s)

    known = [f"{literal(r.before)}(.*?){literal(r.after)}" for r in template.roles]
    generic = f"{literal(template.other[0])}(.*?){literal(template.other[1])}(.*?){literal(template.other[2])}"
    whole = "(?s)" + "|".join([*known, generic])
    n = len(known)
    matches = F.regexp_extract_all(formatted, F.lit(f"(?s){'|'.join([*known, generic]).replace('(.*?)', '.*?')}"), F.lit(0))

    def turn(m: Column) -> Column:
        other = F.lit(True)
        role, text = F.regexp_extract(m, whole, n + 1), F.regexp_extract(m, whole, n + 2)
        for i, r in enumerate(template.roles):
            mine = F.startswith(m, F.lit(r.before))
            other = other & ~mine
            role = F.when(mine, F.lit(r.name)).otherwise(role)
            text = F.when(mine, F.regexp_extract(m, whole, i + 1)).otherwise(text)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(matches, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescaped(s["text"])), "")
