"""Chat formatting: a finite-state machine over roles checks the turn order,
and a declarative template emits text segments with a loss flag each.

Everything is DataFrame expressions. Turns are rendered row by row; only then
are the segments of a conversation gathered, in turn order, into one row. A
conversation is one training text, so it must fit into one row.

Escaping: in texts and roles every backslash becomes ``\\b``, and ``\\e`` is put
after the first character of every control string of the template, so no text
can open, end or split a turn. ``unescape`` is its exact inverse.

Defined results: a null text or role is the empty string; null conversation
ids form one conversation; turns are ordered by turn (null first), then role,
then text, so ties and repeated rows are kept in a fixed order; conversations
whose order the machine rejects are formatted too, with ``valid`` false and
the place of the first rejected turn; columns other than the four are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands around a conversation and its turns, which roles are
    learned, and the machine that accepts turn orders."""

    begin: str = "<s>"
    end: str = "</s>"
    open: str = "<|im_start|>"
    after_role: str = "<|im_sep|>"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Strings with a meaning of their own in this or another chat template.
    control: tuple[str, ...] = ("<s>", "</s>", "<|im_start|>", "<|im_sep|>", "<|im_end|>",
                                "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    #: (state, role) to the next state; the machine starts in "start".
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "opened", ("start", "user"): "asked",
        ("opened", "user"): "asked", ("asked", "assistant"): "answered",
        ("answered", "user"): "asked"})
    final: tuple[str, ...] = ("asked", "answered")


def escape(text: Column, template: Template) -> Column:
    starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.control)
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.regexp_replace(text, F.lit(starts), F.lit("$0\\\\e"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\e"), F.lit(""))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def _machine(roles: Column, template: Template) -> Column:
    """Struct of the last state ("" once rejected), and how many turns were
    accepted."""
    table = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items()
                           for x in (f"{state}\n{role}", to)])

    def step(at: Column, role: Column) -> Column:
        to = F.coalesce(F.try_element_at(table, F.concat(at["state"], F.lit("\n"), role)), F.lit(""))
        return F.struct(to.alias("state"),
                        (at["accepted"] + F.when(to != "", 1).otherwise(0)).alias("accepted"))

    return F.aggregate(roles, F.struct(F.lit("start").alias("state"), F.lit(0).alias("accepted")),
                       step)


def format_conversations(turns: DataFrame, template: Template = Template(), *,
                         conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``valid``, ``bad_turn`` (from 0;
    null if none), ``segments`` (array of text and loss) and ``formatted``, the
    segments joined."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rendered = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.concat(F.lit(template.open), escape(role, template), F.lit(template.after_role)).alias("head"),
        escape(text, template).alias("body")).alias("row"))
    rows = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no, close = F.lit(False), F.lit(template.close)
    body = F.flatten(F.transform("rows", lambda r: F.array(
        segment(r["head"], no), segment(r["body"], r["role"].isin(*template.loss_roles)),
        segment(close, no))))
    framed = F.concat(F.array(segment(F.lit(template.begin), no)), body,
                      F.array(segment(F.lit(template.end), no)))
    machine = rows.select("conv_id", framed.alias("segments"), F.size("rows").alias("n"),
                          _machine(F.transform("rows", lambda r: r["role"]), template).alias("at"))
    return machine.select(
        "conv_id",
        F.col("at.state").isin(*template.final).alias("valid"),
        F.when(F.col("at.accepted") < F.col("n"), F.col("at.accepted")).alias("bad_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted conversation, as an array of role and text."""
    pieces = F.split(formatted, F.lit(re.escape(template.open)))
    turns = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, template.after_role, 1)
        rest = F.substr(piece, F.length(role) + len(template.after_role) + 1)
        text = F.substring_index(rest, template.close, 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    marked = F.filter(segments, lambda s: s["loss"])
    return unescape(F.array_join(F.transform(marked, lambda s: s["text"]), ""))
