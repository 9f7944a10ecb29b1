"""Operator 10: relational chat formatting, in Spark expressions only.

Turns are collected per conversation as structs, sorted, and written one after
another; adjacent turns of one role are merged into one marked block, in which a
separator keeps them apart, so that nothing is lost::

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n

Escaping: ``<``, any number of backslashes and ``|`` in a text or role gets one
more backslash before the bar, so no control string stands inside a text, and
taking one backslash off again restores it.  A line feed in a role is written as
``<|nl|>``.

Every step is linear in a conversation.  Its turns meet in one row, since the
formatted conversation is one string; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings.
START, SEPARATOR, END, LINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _literal(s: str) -> str:
    return s.replace("|", r"\|")


def format_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, segments)`` from rows ``conv_id, turn, role, text``
    (others are ignored).  ``segments`` is ``formatted`` in pieces, ``text`` and
    ``loss``: the loss mask covers the texts of assistant turns and nothing else.
    Turns go by ``turn`` (null first), then role, then text; repeated rows are
    turns of their own; null roles and texts are empty; rows without a
    ``conv_id`` are one conversation."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def written(t: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get("turns", i - 1)["role"] != t["role"])
        closes = (i == F.size("turns") - 1) | (F.get("turns", i + 1)["role"] != t["role"])
        head = F.concat(F.lit(START), F.regexp_replace(escaped(t["role"]), "\n", LINE.replace("|", r"\|").replace("\\", "")), F.lit("\n"))
        return F.array(F.struct(F.when(opens, head).otherwise(F.lit(SEPARATOR)).alias("text"), F.lit(False).alias("loss")),
                       F.struct(escaped(t["text"]).alias("text"), (t["role"] == LEARNED).alias("loss")),
                       F.struct(F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")))

    segments = sorted_.select("conv_id", F.flatten(F.transform("turns", written)).alias("segments"))
    return segments.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role and text, taken from the formatted string
    alone) and ``learned`` (the texts under the loss mask)."""
    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        role = unescaped(F.replace(F.substr(role, F.lit(len(START) + 1)), F.lit(LINE), F.lit("\n")))
        texts = F.split(F.regexp_replace(block, r"\A[^\n]*\n", ""), _literal(SEPARATOR), -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    blocks = F.split("formatted", _literal(END), -1)
    parsed = formatted.withColumn("_blocks", F.filter(blocks, lambda b: b != ""))
    return (parsed.withColumn("turns", F.flatten(F.transform("_blocks", turns))).drop("_blocks")
            .withColumn("learned", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``
    of every conversation, read back from its formatted form."""
    back = read_back(format_conversations(turns)).withColumn("_loss", F.array_join("learned", ""))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
                       F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
