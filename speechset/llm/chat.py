"""Chat formatting by multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered with that speaker as the
assistant and all others as users with their names; the mask covers what the assistant says, with its
end mark. A conversation is rendered in parts of at most ``PART_TURNS`` turn numbers, so that no group
grows with a conversation; the parts in order are the dialogue.

Cases: rows that repeat a conversation, turn, speaker and text are one turn. Turns with the same number
follow each other by speaker, then text. A null turn number comes first; a null text is empty; a null
speaker is a user without a name and no perspective of its own. System turns belong to every
perspective and are none. A conversation without any speaker gives no row. A null conversation id is an
id like others. Marks in a text are broken up, so a text cannot end its own turn. Other columns are not
looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechset.llm.frames import quoted

PART_TURNS = 128
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _header(role: Column, speaker: Column) -> Column:
    name = F.regexp_replace(role, "[^A-Za-z0-9_-]", "_")
    return (
        F.when(role == SYSTEM, F.lit(f"{OPEN}system\n"))
        .when(role == speaker, F.lit(f"{OPEN}assistant\n"))
        .when(role.isNull(), F.lit(f"{OPEN}user\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), name, F.lit("\n")))
    )


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per conversation, perspective and part: conv_id, perspective, part, n_turns, rendered, and
    ``mask``, the spans [start, end) of code points in ``rendered`` that the assistant is trained on."""
    turns = df.select(
        quoted(conv_col).alias("conv_id"),
        quoted(turn_col).cast("bigint").alias("turn"),
        quoted(role_col).cast("string").alias("role"),
        F.replace(F.coalesce(quoted(text_col).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    )
    # Parts go by turn number: by its own hundred-and-odd block, not by a count over the conversation.
    part = F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-1)).cast("bigint")
    # A set, so that repeated rows are one turn; a part holds at most PART_TURNS numbers.
    parts = (
        turns.groupBy("conv_id", part.alias("part"))
        .agg(F.array_sort(F.collect_set(F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("")).alias("k"), "role", "text"))).alias("turns"))
    )
    speakers = turns.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")
    ).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
    me = F.col("perspective")
    shown = F.transform("turns", lambda t: F.struct(_header(t["role"], me).alias("head"), F.concat(t["text"], F.lit(f"{CLOSE}\n")).alias("body"), F.coalesce(t["role"] == me, F.lit(False)).alias("mine")))
    span = "struct<start:bigint,end:bigint>"

    def step(so_far: Column, t: Column) -> Column:
        start = so_far["at"] + F.char_length(t["head"])
        end = start + F.char_length(t["body"])
        # The line feed after the end mark is not trained on.
        own = F.array(F.struct(start.cast("bigint").alias("start"), (end - 1).cast("bigint").alias("end")))
        spans = F.when(t["mine"], F.concat(so_far["spans"], own)).otherwise(so_far["spans"])
        return F.struct(end.cast("bigint").alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    return both.withColumn("_shown", shown).select(
        "conv_id",
        "perspective",
        "part",
        F.size("_shown").alias("n_turns"),
        F.array_join(F.transform("_shown", lambda t: F.concat(t["head"], t["body"])), "").alias("rendered"),
        F.aggregate("_shown", start, step)["spans"].alias("mask"),
    )
