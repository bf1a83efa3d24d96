"""Chat formatting with a grammar round trip.

A turn is rendered as ``<s>`` head body tail ``</s>``; the head and tail tell its role.  A
deterministic parser reads the rendered turn back, and a body that does not come back as it
was, or that holds a control string, is escaped; the whole conversation is parsed once more
at the end and compared with its source.

Null texts and null roles count as empty; a null conversation id is a conversation of its own
id, null; turns with the same number are ordered by role and text, and repeated rows are
turns of their own.  Only the four named columns are read, so other columns cannot clash.  A
conversation is one output string, so it has to fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import whole

OPEN, CLOSE = "<s>", "</s>"
# The marks around a body, by role; any other role is named in its head.
FRAMES = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>"), "assistant": ("", "")}
NAMED, NAMED_END = "[ROLE ", "] "
CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ROLE "
# Escapes are a backslash and a letter, so that no control string is left in an escaped body.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("]", "\\r"))


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _head(role: Column) -> Column:
    head = F.concat(F.lit(NAMED), escape(role), F.lit(NAMED_END))
    for name, (before, _) in FRAMES.items():
        head = F.when(role == name, F.lit(before)).otherwise(head)
    return head


def _tail(role: Column) -> Column:
    tail = F.lit("")
    for name, (_, after) in FRAMES.items():
        tail = F.when(role == name, F.lit(after)).otherwise(tail)
    return tail


def _inside(segment: Column, before: int, after: int) -> Column:
    return segment.substr(F.lit(before + 1), F.char_length(segment) - F.lit(before + after))


def _role_and_body(segment: Column) -> tuple[Column, Column]:
    """Role and still escaped body of what stands between <s> and </s>."""
    role, body = F.lit("assistant"), segment
    role = F.when(segment.startswith(NAMED), unescape(F.substring_index(_inside(segment, len(NAMED), 0), "]", 1))).otherwise(role)
    named = F.instr(segment, NAMED_END)
    body = F.when(segment.startswith(NAMED), segment.substr(named + len(NAMED_END), F.char_length(segment))).otherwise(body)
    for name, (before, after) in FRAMES.items():
        if before:
            framed = segment.startswith(before) & segment.endswith(after) & (F.char_length(segment) >= len(before + after))
            role = F.when(framed, F.lit(name)).otherwise(role)
            body = F.when(framed, _inside(segment, len(before), len(after))).otherwise(body)
    return role, body


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation; a text is null where a body is not in the grammar."""
    segments = F.split(formatted, CLOSE)
    segments = F.slice(segments, F.lit(1), F.size(segments) - 1)

    def turn(segment: Column) -> Column:
        inner = _inside(segment, len(OPEN), 0)
        role, body = _role_and_body(inner)
        fits = segment.startswith(OPEN) & ~body.rlike(CONTROL)
        return F.struct(role.alias("role"), F.when(fits, unescape(body)).alias("text"))

    return F.transform(segments, turn)


def render(turns: DataFrame) -> DataFrame:
    """Add head, body and tail of each turn; a body is escaped only if it does not come back as it is."""
    role, text = F.col("role"), F.col("text")
    framed = turns.withColumns({"head": _head(role), "tail": _tail(role)})
    back_role, back_body = _role_and_body(F.col("plain"))
    same = (back_role == role) & (unescape(back_body) == text) & ~text.rlike(CONTROL)
    tried = framed.withColumn("plain", F.concat("head", "text", "tail")).withColumn("same", same)
    return tried.withColumn("body", F.when(F.col("same"), text).otherwise(escape(text))).drop("plain", "same")


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: formatted string, loss spans of the assistant bodies, round trip.

    Columns: conv_id, formatted, loss_spans (start and end in code points), source turns,
    turns read back, and round_trip, true where both agree.
    """
    turns = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), whole(F.col(role)).alias("role"),
                        whole(F.col(text)).alias("text"))
    pieces = render(turns).withColumns({"head": F.concat(F.lit(OPEN), F.col("head")), "tail": F.concat(F.col("tail"), F.lit(CLOSE))})
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.char_length("head") + F.char_length("body") + F.char_length("tail")
    placed = pieces.select(
        "*", F.row_number().over(ordered).alias("nth"),
        F.sum(size).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("stop"))
    first = F.col("stop") - F.char_length("tail") - F.char_length("body")
    span = F.when(F.col("role") == "assistant",
                  F.struct(first.alias("start"), (first + F.char_length("body")).alias("end")))
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "nth", F.concat("head", "body", "tail").alias("piece"), F.struct("role", "text").alias("source"),
        span.alias("span")))).alias("turns"))
    made = gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.transform("turns", lambda t: t["source"]).alias("source"))
    parsed = made.withColumn("parsed", parse(F.col("formatted")))
    return parsed.withColumn("round_trip", F.col("parsed") == F.col("source"))
