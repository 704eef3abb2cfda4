"""Chat formatting by a finite-state machine over roles and a declarative template.

Built from DataFrame functions alone. The turns of a conversation are put in
order, one fold over their roles runs the machine, and the template turns each
turn into three segments: opening mark, escaped text, closing mark, each with
a flag that says whether the loss covers it.

Texts are escaped so that no control string can occur in them: the escape
character and the two characters that begin a control string become two-letter
codes, and back.

Defined results: turns are ordered by turn, then role, then text, nulls first;
repeated rows are turns of their own; a null text is an empty one and a null
role an empty role; rows of a null conv_id are one conversation; an empty
table gives no conversations; other columns are ignored. A conversation whose
turns break the machine is formatted whole all the same; ``valid`` is false and
``bad_turn`` is the place, from 0, of the first turn out of order (the number
of turns if it only ends too early). A conversation is one row of the output,
so a task holds one whole conversation at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Escapes in order of application: character, code.
ESCAPES = [("\\", "\\e"), ("[", "\\o"), ("]", "\\c"), ("<", "\\l"), (">", "\\g")]


@dataclass(frozen=True)
class Template:
    """Marks and loss per role; ``open_other`` takes the escaped role between its two parts."""

    marks: dict = field(
        default_factory=lambda: {"system": ("[SYS]", "[/SYS]", False), "user": ("[INST]", "[/INST]", False), "assistant": ("[ANS]", "</s>", True)}
    )
    open_other: tuple = ("[ROLE=", "]")
    close_other: str = "[/ROLE]"


#: State after each role; a missing pair rejects. States in ACCEPT may end a conversation.
TRANSITIONS = {
    ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
    ("user", "assistant"): "assistant", ("assistant", "user"): "user",
}
ACCEPT = ("assistant",)


def escape(text: Column) -> Column:
    for char, code in ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for char, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _by_role(role: Column, known: dict, other: Column) -> Column:
    out = other
    for name, value in known.items():
        out = F.when(role == name, value).otherwise(out)
    return out


def format_chats(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, segments array<struct<text, loss>>, formatted, valid, bad_turn`` per conversation."""
    template = template or Template()
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    step = F.create_map(*(F.lit(x) for (state, role), to in TRANSITIONS.items() for x in (f"{state}>{role}", to)))
    # the empty state is the one that rejects
    after = lambda acc, role: F.coalesce(F.try_element_at(step, F.concat(acc["state"], F.lit(">"), role)), F.lit(""))
    machine = F.aggregate(
        F.transform("turns", lambda t: t["role"]),
        F.struct(F.lit("start").alias("state"), F.lit(0).alias("done")),
        lambda acc, role: F.struct(after(acc, role).alias("state"), (acc["done"] + F.when(after(acc, role) == "", 0).otherwise(1)).alias("done")),
    )
    lit = lambda i: {r: F.lit(m[i]) for r, m in template.marks.items()}

    def segments(t: Column) -> Column:
        role = t["role"]
        other = F.concat(F.lit(template.open_other[0]), escape(role), F.lit(template.open_other[1]))
        segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            segment(_by_role(role, lit(0), other), F.lit(False)),
            segment(escape(t["text"]), _by_role(role, lit(2), F.lit(False))),
            segment(_by_role(role, lit(1), F.lit(template.close_other)), F.lit(False)),
        )

    return turns.withColumn("machine", machine).select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        F.col("machine.state").isin(*ACCEPT).alias("valid"),
        F.when(F.col("machine.state").isin(*ACCEPT), F.lit(None)).otherwise(F.col("machine.done")).cast("long").alias("bad_turn"),
    ).withColumn("formatted", F.concat_ws("", F.col("segments.text")))


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    template = template or Template()
    names = "|".join(m[0][1:-1] for m in template.marks.values())
    other = template.open_other[0][1:]
    parts = F.regexp_extract_all(formatted, F.lit(rf"\[(?:{names}|{other}[^\]\[<]*+)\][^\[<]*+(?:\[/[A-Z]++\]|</s>)"), F.lit(0))

    def turn(part: Column) -> Column:
        mark = F.substring_index(part, "]", 1)
        inner = F.regexp_extract(part, r"^\[[^\]]*+\]([^\[<]*+)", 1)
        role = _by_role(mark, {}, unescape(F.substr(mark, F.lit(len(template.open_other[0]) + 1))))
        for name, marks in template.marks.items():
            role = F.when(mark == marks[0][:-1], F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(inner).alias("text"))

    return F.transform(parts, turn)


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Counts and digests of what the formatted conversations hold, read back from them."""
    turns = read_turns(F.col("formatted"), template)
    loss = F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])))
    return (
        chats.withColumn("turns", turns)
        .withColumn("loss_text", loss)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
            F.length("loss_text").cast("long").alias("loss_chars"),
            F.sha2("loss_text", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
            "bad_turn",
        )
    )
