"""Operator 6: chat formatting by a finite-state machine over roles. Native DataFrame operations only.

A declarative template gives each role its opening and closing marks and whether its text is trained on. A
conversation becomes segments (text, loss): opening mark, escaped text, closing mark of every turn. Escaping is
reversible and leaves no character that begins a mark, so marks inside texts are ordinary text.

Defined cases: null text and null role are empty; a role the template doesn't name is written under `other` with its
name and makes the conversation invalid; turns are ordered by (turn, role, text), null turns first; repeated rows are
turns of their own; rows with a null conv_id form one conversation; very long texts are kept whole (a conversation is one row, so its
turns must fit one together); an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Role]
    other: Role
    name_end: str
    moves: dict[str, tuple[str, ...]]
    accept: tuple[str, ...]
    escapes: tuple[tuple[str, str], ...] = field(default=(("\\", "\\e"), ("[", "\\b"), ("<", "\\a")))


INST = Template(
    roles={"system": Role("[SYS]", "[/SYS]"), "user": Role("[INST] ", " [/INST]"), "assistant": Role("[ANS] ", "</s>", loss=True)},
    other=Role("[ROLE]", "[/ROLE]"),
    name_end="[:]",
    moves={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    accept=("assistant",),
)


def escape(text: Column, t: Template) -> Column:
    for plain, code in t.escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, t: Template) -> Column:
    for plain, code in reversed(t.escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _by_role(role: Column, t: Template, known, other: Column) -> Column:
    out = None
    for name, r in t.roles.items():
        out = F.when(role == name, known(r)) if out is None else out.when(role == name, known(r))
    return out.otherwise(other)


def valid_order(roles: Column, t: Template) -> Column:
    """Run the machine over an array of roles: an unknown move leads to `error`, which has no way out."""
    table = F.create_map(*[F.lit(x) for state, nexts in t.moves.items() for n in nexts for x in (f"{state}>{n}", n)])
    step = lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit("error"))
    return F.aggregate(roles, F.lit("start"), step).isin(*t.accept)


def format_chats(turns: DataFrame, template: Template = INST) -> DataFrame:
    """conv_id, valid, segments array<struct<text, loss>>, formatted (the segments joined)."""
    t = template
    row = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def written(x: Column) -> Column:
        name = F.concat(F.lit(t.other.open), escape(x["role"], t), F.lit(t.name_end))
        opening = _by_role(x["role"], t, lambda r: F.lit(r.open), name)
        closing = _by_role(x["role"], t, lambda r: F.lit(r.close), F.lit(t.other.close))
        loss = _by_role(x["role"], t, lambda r: F.lit(r.loss), F.lit(t.other.loss))
        part = lambda text, on: F.struct(text.alias("text"), on.alias("loss"))
        return F.array(part(opening, F.lit(False)), part(escape(x["text"], t), loss), part(closing, F.lit(False)))

    made = chats.select("conv_id", valid_order(F.transform("turns", lambda x: x["role"]), t).alias("valid"), F.flatten(F.transform("turns", written)).alias("segments"))
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(chats: DataFrame, template: Template = INST) -> DataFrame:
    """Add `read`, array<struct<role, text>>: the turns, recovered from the formatted string alone."""
    t = template
    quote = lambda s: "".join("\\" + c if c in r"\[]<>/(){}.*+?|^$" else c for c in s)
    body = "([^\\[<]*)"
    forms = [quote(r.open) + body + quote(r.close) for r in t.roles.values()]
    forms.append(quote(t.other.open) + body + quote(t.name_end) + body + quote(t.other.close))
    found = F.regexp_extract_all("formatted", F.lit("|".join(forms)), F.lit(0))

    def parsed(x: Column) -> Column:
        inner = lambda r: F.struct(F.lit(name).alias("role"), unescape(F.substr(x, F.lit(len(r.open) + 1), F.length(x) - len(r.open) - len(r.close)), t).alias("text"))
        out = None
        for name, r in t.roles.items():
            hit = F.startswith(x, F.lit(r.open))
            out = F.when(hit, inner(r)) if out is None else out.when(hit, inner(r))
        rest = F.substr(x, F.lit(len(t.other.open) + 1), F.length(x) - len(t.other.open) - len(t.other.close))
        cut = F.instr(rest, t.name_end)
        other = F.struct(unescape(F.substr(rest, F.lit(1), cut - 1), t).alias("role"), unescape(F.substr(rest, cut + len(t.name_end)), t).alias("text"))
        return out.otherwise(other)

    return chats.withColumn("read", F.transform(found, parsed))
