"""Perspective rotation of dialogues, in DataFrame functions alone.

For every participant of a conversation the dialogue is written out once with that speaker as
``assistant`` and the others as ``user`` with their name; system turns stay system turns and a conversation of
system turns alone has no participants. The mask marks what the assistant says, end mark included, as character
ranges ``start-end`` of the text, ``end`` excluded.

A dialogue is whole, however long: one row per speaker, which holds its text and mask. Rows that agree in conversation, turn, role
and text are one turn, so a conversation repeated many times is reduced before its turns are brought together. Turns with the same number are ordered by role, then text; a NULL number comes first.
A NULL role is the speaker ``unknown``, a NULL text is empty, rows without conversation id belong to no dialogue and
are left out. Marks inside a text get a zero-width space, so that they cannot end a turn. No rows give no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _head(role: Column, speaker: Column) -> Column:
    shown = F.when(role == speaker, "assistant").when(role == "system", "system").otherwise(F.concat(F.lit("user name="), role))
    return F.concat(F.lit(OPEN), shown, F.lit("\n"))


def rotate(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``speaker``, ``messages`` (role, name, content, trained), ``text``, ``mask``."""
    safe = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("<​|"))
    turns = conversations.filter("conv_id is not null").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), safe.alias("content")).distinct()
    dialogue = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "content"))).alias("turns"))
    speakers = turns.filter("role <> 'system'").select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    rotated = dialogue.join(speakers, F.col("conv_id") == F.col("_conv"))
    speaker = F.col("speaker")

    def message(turn: Column) -> Column:
        return F.struct(
            F.when(turn["role"] == speaker, "assistant").when(turn["role"] == "system", "system").otherwise("user").alias("role"),
            F.when((turn["role"] != speaker) & (turn["role"] != "system"), turn["role"]).alias("name"),
            turn["content"].alias("content"), (turn["role"] == speaker).alias("trained"))

    def step(so_far: Column, turn: Column) -> Column:
        start = so_far["at"] + F.char_length(_head(turn["role"], speaker))
        end = start + F.char_length(turn["content"]) + len(CLOSE)
        spoken = F.concat(start.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct((end + 1).cast("long").alias("at"), F.when(turn["role"] == speaker, F.concat(so_far["ranges"], F.array(spoken)))
                        .otherwise(so_far["ranges"]).alias("ranges"))

    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("ranges"))
    return rotated.select(
        "conv_id", "speaker", F.transform("turns", message).alias("messages"),
        F.array_join(F.transform("turns", lambda t: F.concat(_head(t["role"], speaker), t["content"], F.lit(CLOSE + "\n"))), "").alias("text"),
        F.array_join(F.aggregate("turns", nothing, step, lambda done: done["ranges"]), ";").alias("mask"))
