"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns
of one role become one block; blocks are concatenated.  Template::

    <s>[ROLE]user[/ROLE]text[NEXT]more text of the same role</s>[ROLE]assistant[/ROLE]text</s>

Control strings inside texts and roles are escaped by a backslash after their first
character (and backslashes are doubled), so a formatted conversation holds a control
string only where the template put it, and can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import pick

START, ROLE, ROLE_END, NEXT, END = "<s>", "[ROLE]", "[/ROLE]", "[NEXT]", "</s>"
#: Escaped in texts: this template's own control strings and two common ones.
CONTROL = [START, END, ROLE, ROLE_END, NEXT, "[INST]", "[/INST]"]
_TAILS = "|".join(c[1:].replace("]", r"\]") for c in CONTROL)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])(?=(?:{_TAILS}))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation: ``conv_col, formatted, loss_spans``.

    Turns go by ``turn_col`` (nulls first), ties by role and text; repeated rows are
    repeated turns.  Null roles and texts count as empty.  ``loss_spans`` are
    the places of the loss role's texts in the UTF-8 bytes of ``formatted``, one for each turn.
    A null conversation id is a conversation like any other.
    """
    src = pick(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col).select(
        "conv", F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    convs = src.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before = F.get(F.col("turns"), i - 1)
        same = (i > 0) & before["role"].eqNullSafe(t["role"])
        head = F.when(same, F.lit(NEXT)).otherwise(F.concat(
            F.when(i > 0, F.lit(END)).otherwise(F.lit(START)), F.lit(ROLE), escape(t["role"]), F.lit(ROLE_END)))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"))

    pieces = convs.select("conv", F.transform("turns", piece).alias("p"))
    spans = F.aggregate(
        "p", F.struct(F.lit(0).cast("bigint").alias("at"),
                      F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.octet_length(x["head"]) + F.octet_length(x["body"])).alias("at"),
            F.when(x["loss"], F.array_append(acc["spans"], F.struct(
                (acc["at"] + F.octet_length(x["head"])).alias("start"),
                F.octet_length(x["body"]).cast("bigint").alias("length")))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return pieces.select(
        F.col("conv").alias(conv_col),
        F.concat(F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"])), ""),
                 F.lit(END)).alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>, unescaped."""
    inner = F.substr(formatted, F.lit(len(START) + 1), F.length(formatted) - len(START) - len(END))
    blocks = F.split(inner, "</s>", -1)

    def block(b: Column) -> Column:
        parts = F.split(F.substr(b, F.lit(len(ROLE) + 1)), r"\[/ROLE\]", 2)
        return F.transform(F.split(parts[1], r"\[NEXT\]", -1),
                           lambda t: F.struct(unescape(parts[0]).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, block))


def read_loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.decode(
        F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8"))), "")
