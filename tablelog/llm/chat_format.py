r"""Conversations as training text that reads back identically (operator 9).

A conversation is the sequence of its turns, each

    <|im_start|>ROLE newline TEXT <|im_end|> newline

A deterministic parser reads it: a turn runs from one start mark to the next end mark, its role ends
at the first line end, and the marks may stand nowhere else. Every conversation is rendered, read
back and compared with its source. If anything differs, its content is escaped and it is rendered
again: first its texts, then its roles as well, until both are identical.

Escaping puts one backslash between ``<`` and ``|`` of every ``<|``, and one more where there are
some already; reading takes one away. A line end in a role becomes the mark ``<|nl|>``. So escaped
content never holds a mark, and any content comes back.

Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.llm.storage import column

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"

_MARK = r"<\|(?:im_start|im_end|nl)\|>"
_TURN = r"(?s)<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n"


def escaped(x: Column) -> Column:
    return F.regexp_replace(x, r"<(\\*)\|", r"<\\$1|")


def unescaped(x: Column) -> Column:
    return F.regexp_replace(x, r"<\\(\\*)\|", r"<$1|")


def _render(turns: Column, text, role) -> Column:
    turn = lambda t: F.concat(F.lit(START), role(t["role"]), F.lit("\n"), text(t["text"]), F.lit(f"{END}\n"))
    return F.array_join(F.transform(turns, turn), "")


def parsed(formatted: Column) -> Column:
    """The turns ``(role, text)`` that a formatted conversation holds."""
    roles = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    read = lambda r, t: F.struct(unescaped(F.replace(r, F.lit(LINE), F.lit("\n"))).alias("role"), unescaped(t).alias("text"))
    return F.zip_with(roles, texts, read)


def _reads_back(formatted: Column, turns: Column, marks: Column) -> Column:
    plain = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return (F.regexp_count(formatted, F.lit(_MARK)) == marks) & (parsed(formatted) == plain)


def format_conversations(
    turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: str = "assistant"
) -> DataFrame:
    """``(conv_id, formatted, level, loss)``, one row per conversation.

    Rows are ordered by turn, NULL first, equal turns by role and text. ``level`` says what had to be
    escaped: 0 nothing, 1 texts, 2 texts and roles. ``loss`` has the spans ``[from, to)`` of
    ``formatted`` in code points that a model learns from, one per turn of the role ``learned``.

    A NULL role or text is empty. A NULL key is a conversation like others. Equal rows are turns of
    their own. An empty table gives no rows. Other columns are ignored. A conversation is one value
    and so must fit in a row.
    """
    rows = turns.select(
        column(turns, key).alias("conv_id"),
        F.struct(
            column(turns, turn).alias("turn"),
            F.coalesce(column(turns, role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(column(turns, text).cast("string"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    out = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    same = lambda x: x
    one_line = lambda x: F.replace(escaped(x), F.lit("\n"), F.lit(LINE))
    t = F.col("turns")
    out = out.withColumn("formatted", _render(t, same, same)).withColumn("level", F.lit(0))
    for level, read_role in ((1, same), (2, one_line)):
        out = out.withColumn("good", _reads_back(F.col("formatted"), t, 2 * F.size(t)))
        out = out.withColumn("formatted", F.when(F.col("good"), F.col("formatted")).otherwise(_render(t, escaped, read_role)))
        out = out.withColumn("level", F.when(F.col("good"), F.col("level")).otherwise(F.lit(level)))
    breaks = F.aggregate(t, F.lit(0), lambda n, x: n + F.regexp_count(x["role"], F.lit("\n")))
    marks = 2 * F.size(t) + F.when(F.col("level") == 2, breaks).otherwise(F.lit(0))
    failed = F.raise_error(F.concat(F.lit("does not read back: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("NULL"))))
    out = out.withColumn("formatted", F.when(_reads_back(F.col("formatted"), t, marks), F.col("formatted")).otherwise(failed.cast("string")))
    return out.select("conv_id", "formatted", "level", _spans(t, F.col("level"), learned, one_line).alias("loss"))


def _spans(turns: Column, level: Column, learned: str, one_line) -> Column:
    """Where texts of the learned role stand: lengths of what comes before, added up."""

    def add(done, x):
        role = F.length(F.when(level == 2, one_line(x["role"])).otherwise(x["role"]))
        text = F.length(F.when(level > 0, escaped(x["text"])).otherwise(x["text"]))
        start = done["at"] + len(START) + role + 1
        span = F.array(F.struct(start.alias("from"), (start + text).alias("to")))
        spans = F.when(x["role"] == learned, F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((start + text + len(END) + 1).alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<from: int, to: int>>")
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda x: x["spans"])


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    part = lambda s: unescaped(F.substring(formatted, s["from"] + 1, s["to"] - s["from"]))
    return F.array_join(F.transform(loss, part), "")
