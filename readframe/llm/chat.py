"""Chat formatting with DataFrame functions only: a role machine, a declarative template, loss flags, reading back.

Turns are ordered by (turn, role, text), nulls first, so repeated rows are kept and equal rows are interchangeable.
Each conversation is worked on in stretches of ``STRETCH`` turn numbers: windows see one stretch, and one summary
row per stretch carries the machine's state and the turn count on to the next. A conversation that holds a third of
all rows is thus spread over tasks. Only ``read_back`` puts a conversation together, as one string of its text.

Defined results: a null role is an empty one and a null text an empty text; a null conversation id is a conversation
of its own; an empty table gives no segments; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

STRETCH = 256


@dataclass(frozen=True)
class Template:
    """``before role between text after``, once per turn.

    ``escapes`` replaces single characters of roles and texts by two: the first is always the escape character, which
    comes first in the mapping. ``between`` must hold a character that is escaped in roles, ``after`` and ``before``
    one that is escaped everywhere, so that no control string can arise inside a text.
    """

    before: str = "### "
    between: str = ": "
    after: str = " </turn>\n"
    escapes: dict[str, str] = field(default_factory=lambda: {"\\": "\\b", "#": "\\h", "<": "\\l"})
    role_escapes: dict[str, str] = field(default_factory=lambda: {":": "\\c"})
    loss_roles: tuple[str, ...] = ("assistant",)
    # The machine: its state is the role of the last turn; which roles may follow, and with which it may end.
    start: tuple[str, ...] = ("system", "user")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        mark = next(iter(self.escapes), "")
        every = {**self.escapes, **self.role_escapes}
        if len(mark) != 1 or any(len(k) != 1 or len(v) != 2 or v[0] != mark for k, v in every.items()):
            raise ValueError("escapes are single characters, each replaced by the escape character and a letter")
        if len({v for v in every.values()}) != len(every) or any(v[1] in every for v in every.values()):
            raise ValueError("each escape needs a letter of its own that is not escaped")
        if not all(set(s) & set(self.escapes) for s in (self.before, self.after)) or not set(self.between) & set(every):
            raise ValueError("each control string needs an escaped character")

    def escape(self, text: Column, role: bool = False) -> Column:
        for char, code in {**self.escapes, **(self.role_escapes if role else {})}.items():
            text = F.replace(text, F.lit(char), F.lit(code))
        return text

    def unescape(self, text: Column, role: bool = False) -> Column:
        every = {**self.escapes, **(self.role_escapes if role else {})}
        for char, code in reversed(every.items()):
            text = F.replace(text, F.lit(code), F.lit(char))
        return text


def format_chats(
    turns: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Text segments: ``conv_id, turn_no, part, text, loss, turn_ok``.

    ``turn_no`` counts a conversation's turns from 0; parts 0, 1, 2 of a turn are its header, its escaped text and its
    end mark. ``loss`` is true for the text of a loss role only. ``turn_ok`` says whether the machine allows the turn
    after the one before it (and the conversation to end there, if it is the last).
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col(turn_col) / STRETCH), F.lit(-(2**62))).cast("bigint").alias("stretch"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    within = Window.partitionBy("conv_id", "stretch").orderBy(*order)
    rows = rows.withColumn("n", F.row_number().over(within)).withColumn("prior", F.lag("role").over(within))
    key = F.struct(F.col("turn").isNotNull(), "turn", "role", "text")
    along = Window.partitionBy("conv_id").orderBy("stretch")
    stretches = (
        turns_summary(rows, key)
        .withColumn("carried", F.lag("last_role").over(along))
        .withColumn("first_no", F.coalesce(F.sum("turns").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("final", F.lead("stretch").over(along).isNull())
        .select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), "carried", "first_no", "final", "turns")
    )
    rows = rows.join(stretches, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s")))
    state = F.coalesce("prior", "carried")
    allowed = F.when(state.isNull(), F.col("role").isin(*template.start))
    for role, after in template.follows.items():
        allowed = allowed.when(state == role, F.col("role").isin(*after))
    last = F.col("final") & (F.col("n") == F.col("turns"))
    parts = F.array(
        _segment(F.concat(F.lit(template.before), template.escape(F.col("role"), True), F.lit(template.between)), F.lit(False)),
        _segment(template.escape(F.col("text")), F.col("role").isin(*template.loss_roles)),
        _segment(F.lit(template.after), F.lit(False)),
    )
    return rows.select(
        "conv_id",
        (F.col("first_no") + F.col("n") - 1).alias("turn_no"),
        (allowed.otherwise(F.lit(False)) & (~last | F.col("role").isin(*template.ends))).alias("turn_ok"),
        F.posexplode(parts).alias("part", "segment"),
    ).select("conv_id", "turn_no", "part", "segment.text", "segment.loss", "turn_ok")


def turns_summary(rows: DataFrame, key: Column) -> DataFrame:
    """One row per stretch: its number of turns and its last role."""
    return rows.groupBy("conv_id", "stretch").agg(F.count("*").alias("turns"), F.max_by("role", key).alias("last_role"))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _joined(segments: DataFrame) -> DataFrame:
    """The text of the segments in order and the turns out of order, first per stretch, then per conversation."""
    parts = F.array_sort(F.collect_list(F.struct("turn_no", "part", "text", "loss")))
    near = segments.groupBy("conv_id", F.floor(F.col("turn_no") / STRETCH).alias("stretch")).agg(
        parts.alias("p"), F.count_if((F.col("part") == 0) & ~F.col("turn_ok")).alias("bad")
    )
    near = near.select(
        "conv_id",
        "stretch",
        F.array_join(F.col("p.text"), "").alias("text"),
        F.array_join(F.filter("p", lambda x: x["loss"])["text"], "").alias("loss_text"),
        "bad",
    )
    whole = near.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("stretch", "text", "loss_text"))).alias("p"), F.sum("bad").alias("n_bad_turns")
    )
    return whole.select(
        "conv_id", F.array_join("p.text", "").alias("formatted"), F.array_join("p.loss_text", "").alias("loss_text"), "n_bad_turns"
    )


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, formatted, turns (role, text), loss_text, n_bad_turns``; turns are parsed from the segments' text alone.

    ``n_bad_turns`` counts the turns that the machine does not allow where they stand.
    """
    turn = F.filter(F.split("formatted", re.escape(template.after)), lambda x: x != "")
    skip = len(template.before)

    def parse(x: Column) -> Column:
        role = F.substring_index(F.substring(x, skip + 1, 2**31 - 1), template.between, 1)
        text = F.substr(x, F.length(role) + skip + len(template.between) + 1)
        return F.struct(template.unescape(role, True).alias("role"), template.unescape(text).alias("text"))

    return _joined(segments).select(
        "conv_id", "formatted", F.transform(turn, parse).alias("turns"), template.unescape(F.col("loss_text")).alias("loss_text"),
        "n_bad_turns",
    )
