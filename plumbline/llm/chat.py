"""Operator 6: conversations as training text, by Spark expressions only.

A block is ``<s>role[INST]text</s>``; adjacent turns of one role share a block,
with ``[/INST]`` between their texts. A control string inside a text or a role
gets a backslash after its first character (and one more if it has some), which
reading takes away again, so any text comes back as it was. The loss mask is a list
of spans of the output, one for each assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SAY, NEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = r"([<\[])(\\*)(s>|/s>|INST\]|/INST\])"
_HELD = r"([<\[])\\(\\*)(s>|/s>|INST\]|/INST\])"


def escape(text: Column) -> Column:
    """A text in which no control string is left."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""
    return F.regexp_replace(text, _HELD, r"$1$2$3")


def collect_turns(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, turns): the turns of a conversation as sorted structs.

    One conversation is one output row, so its turns do meet in one task: that
    is what the operator returns, and its size is the size of that row.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def format_chat(turns: DataFrame, learn_role: str = "assistant", conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, formatted, loss): the text, and its loss spans as structs of
    ``at`` and ``n`` in code points.

    Turns are ordered by turn, role and text (nulls first); null role or text is
    empty; rows of a null conv_id are one conversation; repeated rows are turns
    each; an empty table gives no row.
    """
    merged = F.aggregate(
        "turns",
        F.array().cast("array<struct<role:string,texts:array<string>>>"),
        lambda held, t: F.when(
            (F.size(held) > 0) & (F.element_at(held, -1)["role"] == t["role"]),
            F.concat(F.slice(held, 1, F.size(held) - 1), F.array(F.struct(t["role"].alias("role"), F.concat(F.element_at(held, -1)["texts"], F.array(t["text"])).alias("texts")))),
        ).otherwise(F.concat(held, F.array(F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))))),
    )
    # pieces of the output in order, each with whether it is learnt
    piece = lambda text, on: F.struct(text.alias("text"), on.alias("on"))
    said = lambda b: F.transform(
        b["texts"],
        lambda x, i: F.array(piece(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)), F.lit(False)), piece(escape(x), b["role"] == learn_role)),
    )
    block = lambda b: F.concat(F.array(piece(F.concat(F.lit(OPEN), escape(b["role"]), F.lit(SAY)), F.lit(False))), F.flatten(said(b)), F.array(piece(F.lit(CLOSE), F.lit(False))))
    blocks = collect_turns(turns, conv_col).select("conv_id", merged.alias("blocks"))
    pieces = blocks.select("conv_id", F.flatten(F.transform("blocks", block)).alias("pieces"))
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,n:int>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["text"])).alias("at"),
            F.when(p["on"], F.concat(s["spans"], F.array(F.struct(s["at"].alias("at"), F.length(p["text"]).alias("n"))))).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return pieces.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), spans.alias("loss"))


def parse_chat(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, learnt, formatted): the turns as structs of role and text
    and the texts under the loss mask, from the output alone."""
    whole = F.col("formatted")
    # no control string is left in a text, so splitting at them is safe
    blocks = F.transform(F.filter(F.split(whole, "</s>"), lambda b: b != ""), lambda b: b.substr(F.lit(len(OPEN) + 1), F.length(b)))
    turn = lambda b: F.transform(
        F.split(F.split(b, r"\[INST\]", 2)[1], r"\[/INST\]"),
        lambda t: F.struct(unescape(F.split(b, r"\[INST\]", 2)[0]).alias("role"), unescape(t).alias("text")),
    )
    learnt = F.transform("loss", lambda s: unescape(whole.substr(s["at"] + 1, s["n"])))
    return formatted.select("conv_id", F.flatten(F.transform(blocks, turn)).alias("turns"), learnt.alias("learnt"), "formatted")


def chat_digest(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Format, read back, and reduce each conversation to counts and hashes."""
    back = parse_chat(format_chat(turns, conv_col=conv_col))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learnt", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
