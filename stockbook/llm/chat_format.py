"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted by turn, merged where
neighbours have one role, and concatenated under a template::

    <|start|>role\\n text <|turn|> text <|end|>\\n      (no blanks around marks)

Inside texts and roles a backslash becomes ``\\s`` and ``<|`` becomes ``\\l``
(in roles a line break becomes ``\\e``), so no text can hold a mark and the
escapes undo exactly. Besides the formatted string the output has it as
segments with a flag: under the loss mask are exactly the assistant's texts.

Defined cases: null text and null role count as empty strings; a null turn
sorts first; equal turns are ordered by role, then text; repeated rows stay as
turns of their own; rows with a null conv_id form one conversation; other
columns are not looked at. A conversation is one string by definition, so its
size bounds the work of a task; all steps are linear in its turns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TURN, END = "<|start|>", "<|turn|>", "<|end|>\n"
LOSS_ROLE = "assistant"


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escape(c: Column) -> Column:
    return _replace(_replace(c, "\\", "\\s"), "<|", "\\l")


def unescape(c: Column) -> Column:
    return _replace(_replace(c, "\\l", "<|"), "\\s", "\\")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, evaluated once even where lambdas repeat it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merge_turns(turns: Column) -> Column:
    """Sorted turn structs -> runs of neighbours with one role: (role, texts)."""
    def runs(x: Column) -> Column:
        n = F.size(x["turns"])
        def run(s: Column, k: Column) -> Column:
            stop = F.coalesce(F.get(x["starts"], k + 1), n)
            own = F.slice(x["turns"], s + 1, stop - s)
            return F.struct(F.get(own, F.lit(0))["role"].alias("role"), F.transform(own, lambda t: t["text"]).alias("texts"))
        return F.transform(x["starts"], run)

    def starts(t: Column) -> Column:
        return F.struct(t.alias("turns"), F.filter(
            F.sequence(F.lit(0), F.size(t) - 1),
            lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])).alias("starts"))

    return _let(turns, lambda t: _let(starts(t), runs))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def block_segments(block: Column) -> Column:
    no = F.lit(False)
    role = _replace(escape(block["role"]), "\n", "\\e")
    head = F.array(_segment(F.concat(F.lit(START), role, F.lit("\n")), no))
    body = F.flatten(F.transform(block["texts"], lambda t, i: F.concat(
        F.when(i > 0, F.array(_segment(F.lit(TURN), no))).otherwise(F.array().cast("array<struct<text:string,loss:boolean>>")),
        F.array(_segment(escape(t), block["role"] == LOSS_ROLE)))))
    return F.concat(head, body, F.array(_segment(F.lit(END), no)))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, segments array<struct<text, loss>> (they join to ``formatted``)."""
    rows = conversations.select("conv_id", F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    seg = grouped.select("conv_id", F.flatten(F.transform(merge_turns(F.col("turns")), block_segments)).alias("segments"))
    return seg.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse_chat(formatted: Column) -> Column:
    """The template undone: array<struct<role, texts>>, one entry a block."""
    blocks = F.split(formatted, r"<\|end\|>\n", -1)
    def block(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        role = unescape(_replace(F.substring(head, len(START) + 1, F.length(head)), "\\e", "\n"))
        body = F.substring(b, F.length(head) + 2, F.length(b))
        return F.struct(role.alias("role"), F.transform(F.split(body, r"<\|turn\|>", -1), unescape).alias("texts"))
    return F.transform(F.slice(blocks, 1, F.size(blocks) - 1), block)


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What is read back from the formatted strings and the loss mask."""
    back = formatted.select("conv_id", "formatted", parse_chat(F.col("formatted")).alias("blocks"), F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("loss"))
    turns = F.array_join(F.flatten(F.transform("blocks", lambda b: F.transform(
        b["texts"], lambda t: F.concat(b["role"], F.lit("\n"), t, F.lit("\n"))))), "")
    n_turns = F.aggregate("blocks", F.lit(0).cast("long"), lambda n, b: n + F.size(b["texts"]))
    return back.select("conv_id", n_turns.alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
