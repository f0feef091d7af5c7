"""Chat formatting: a state machine over roles, a declarative template, text segments with loss flags.

Everything is a projection of built-in functions over one grouped table; no Python code runs in a task.
A conversation is one row of the result, so its turns meet in one place; nothing else does. Many equal
conversations are rows of their own and spread by their ids.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrail.llm.text import whole

# What escapes a control string inside a text; a text's own are doubled. No mark may hold it.
ESCAPE = "\\"
_SPAN = "struct<start:bigint,end:bigint>"


@dataclass(frozen=True)
class Marks:
    """What stands before and after the text of a turn, and whether the text counts for the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """`roles` have marks of their own; `other` are the marks before the role, before the text and behind the text of any other role.

    `control` are the strings that no text may show. `steps` are the edges of the state machine, (state, role)
    to the next state; a conversation is valid if every turn has an edge and the last state is one of `ends`.
    """

    roles: dict[str, Marks]
    other: tuple[str, str, str]
    control: tuple[str, ...]
    steps: dict[tuple[str, str], str]
    start: str
    ends: tuple[str, ...]

    def __post_init__(self):
        marks = [*(m for own in self.roles.values() for m in (own.before, own.after)), *self.other]
        if any(ESCAPE in mark for mark in (*marks, *self.control)):
            raise ValueError("marks and control strings must be free of the escape character")
        for mark in self.control:
            if len(mark) < 2 or re.search(r"\s", mark) or any(mark.endswith(mark[:k]) for k in range(1, len(mark))):
                raise ValueError("control strings need two characters or more, no white space and no end that is also their start")
        ends = [own.after for own in self.roles.values()] + [self.other[1], self.other[2]]
        if any(end.strip() not in self.control for end in ends):
            raise ValueError("what ends a role or a text has to be a control string")
        starts = [own.before for own in self.roles.values()] + [self.other[0]]
        if any(not a or (a is not b and b.startswith(a)) for a in starts for b in starts):
            raise ValueError("what starts a turn has to tell the roles apart")


TEMPLATE = Template(
    roles={
        "system": Marks("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks(" ", " </s>", loss=True),
    },
    other=("<|role|>", "<|text|>", "<|end|>"),
    control=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>"),
    steps={
        ("start", "system"): "told",
        ("start", "user"): "asked",
        ("told", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    start="start",
    ends=("answered",),
)


def _java(plain: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|<>/-])", r"\\\1", plain).replace("\n", r"\n")


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    """The text with its escape characters doubled and one put behind the first character of every control string.

    Only that character is replaced and the rest looked at, so overlapping control strings are all broken.
    """
    firsts = "|".join(f"{_java(mark[0])}(?={_java(mark[1:])})" for mark in template.control)
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, firsts, r"$0\\")


def unescaped(text: Column) -> Column:
    """The inverse of `escaped`: of two escape characters one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _pieces(role: Column, text: Column, template: Template) -> Column:
    """The pieces of one turn in order: mark, text, mark, each with its loss flag."""

    def piece(own: Column, loss: bool) -> Column:
        return F.struct(own.alias("text"), F.lit(loss).alias("loss"))

    start, middle, end = template.other
    pieces = F.array(
        piece(F.concat(F.lit(start), escaped(role, template), F.lit(middle)), False), piece(text, False), piece(F.lit(end), False)
    )
    for name, marks in template.roles.items():
        own = F.array(piece(F.lit(marks.before), False), piece(text, marks.loss), piece(F.lit(marks.after), False))
        pieces = F.when(role == name, own).otherwise(pieces)
    return pieces


def _run(turns: Column, template: Template) -> Column:
    """Runs the machine over the roles: its state (empty once a turn has no edge) and the number of turns it took."""
    edges = F.create_map(*[F.lit(x) for (state, role), to in template.steps.items() for x in (f"{state}\n{role}", to)])

    def step(so_far: Column, turn: Column) -> Column:
        to = F.coalesce(edges[F.concat(so_far["state"], F.lit("\n"), turn["role"])], F.lit(""))
        return F.struct(to.alias("state"), (so_far["taken"] + F.when(to == "", 0).otherwise(1)).alias("taken"))

    start = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("taken"))
    return F.aggregate(turns, start, step)


def format_chats(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = TEMPLATE,
) -> DataFrame:
    """`conv_id, valid, bad_turn, segments, formatted, loss_spans`, one row for each conversation.

    Every conversation is formatted, whether `valid` or not; `bad_turn` is the place (from 0) of the first turn
    that the state machine refuses, the number of turns if only the end is wrong, else null. `segments` are
    text and loss flag in order, `formatted` is their concatenation, `loss_spans` are start and end (code points,
    end exclusive) of the segments that count for the loss, empty ones too.

    Null roles and texts count as empty. Turns go by number, null last, then by role and text; repeated rows
    are turns of their own. Rows without conversation id are one conversation, as grouping makes them.
    Texts of any length and content come back from `read_back`. An empty table gives no rows; other columns
    are ignored.
    """
    given = df.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).isNull().alias("no_turn"),
        F.col(turn).alias("turn"),
        whole(role).alias("role"),
        whole(text).alias("text"),
    ).repartition("conv_id")
    order = ["no_turn", "turn", "role", "text"]
    pieces = given.withColumn("pieces", _pieces(F.col("role"), escaped(F.col("text"), template), template))
    sized = pieces.withColumn("n_chars", F.aggregate("pieces", F.lit(0).cast("bigint"), lambda n, p: n + F.length(p["text"])))
    # Plain turns were shuffled above; windows and grouping find them in place. Equal rows stand in any order, which
    # gives the same text.
    before = Window.partitionBy("conv_id").orderBy(*order, "n_chars").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.select(
        "conv_id",
        F.coalesce(F.sum("n_chars").over(before), F.lit(0).cast("bigint")).alias("at"),
        F.row_number().over(Window.partitionBy("conv_id").orderBy(*order, "n_chars")).alias("place"),
        "role",
        "pieces",
    )
    turns = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "at", "role", "pieces"))).alias("turns"))

    def spans(turn: Column) -> Column:
        first, middle, _ = [F.element_at(turn["pieces"], k) for k in (1, 2, 3)]
        start = turn["at"] + F.length(first["text"])
        span = F.struct(start.alias("start"), (start + F.length(middle["text"])).alias("end"))
        return F.when(middle["loss"], F.array(span)).otherwise(F.array().cast(f"array<{_SPAN}>"))

    run = turns.withColumn("run", _run(F.col("turns"), template)).withColumn(
        "segments", F.flatten(F.transform("turns", lambda t: t["pieces"]))
    )
    ended = F.col("run.state").isin(*template.ends)
    return run.select(
        "conv_id",
        ended.alias("valid"),
        F.when(~ended, F.col("run.taken")).alias("bad_turn"),
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
        F.flatten(F.transform("turns", spans)).alias("loss_spans"),
    )


def read_back(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns of a formatted conversation, as an array of role and text; the inverse of `format_chats`.

    Turns follow each other without a gap, each starts with a mark that tells its role, and no text shows
    the mark that ends it, so the first end mark is the end. One pass finds the turns, another takes them apart.
    """
    start, middle, end = map(_java, template.other)
    shapes = [f"{_java(own.before)}.*?{_java(own.after)}" for own in template.roles.values()]
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join([*shapes, f"{start}.*?{middle}.*?{end}"])), F.lit(0))

    def taken_apart(shown: Column) -> Column:
        def between(before: str, after: str) -> Column:
            return shown.substr(F.lit(len(before) + 1), F.length(shown) - (len(before) + len(after)))

        first, second, last = template.other
        parts = F.split(between(first, last), _java(second), 2)
        turn = F.struct(unescaped(F.element_at(parts, 1)).alias("role"), unescaped(F.element_at(parts, 2)).alias("text"))
        for name, own in template.roles.items():
            known = F.struct(F.lit(name).alias("role"), unescaped(between(own.before, own.after)).alias("text"))
            turn = F.when(shown.startswith(own.before), known).otherwise(turn)
        return turn

    return F.transform(found, taken_apart)


def loss_text(segments: Column) -> Column:
    """What stands under the loss mask, unescaped: the texts one behind the other."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
