"""Chat formatting: every participant of a dialogue in turn is the assistant.

For each participant the whole dialogue is rendered once: this speaker's turns as the assistant, all others as named users,
system turns as context. The mask holds the character spans of the assistant's own words, end marker included, which are
what a model is trained on.

A perspective is one row, so a dialogue has to fit into memory as many times as a task renders perspectives at once. Where some
don't, ``part_bytes`` cuts the rendered form into parts; by default there is none and nothing is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The markers of the rendered form, and what the first one becomes inside a message.
OPEN, CLOSE, ESCAPED = "<|im_start|>", "<|im_end|>", "<❘im_"


def escaped(text: Column) -> Column:
    """A message can't open or close a turn: its own markers are spelled with another bar."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit(ESCAPED))


def participants(turns: DataFrame, conversation: str, speaker: str, system: str) -> DataFrame:
    """The distinct speakers of each conversation, without the system and nameless turns."""
    return (
        turns.where(F.col(speaker).isNotNull() & (F.col(speaker) != system))
        .select(F.col(conversation).alias("__conversation"), F.col(speaker).alias("__self"))
        .distinct()
    )


def rotate_perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system: str = "system",
    part_bytes: int | None = None,
) -> DataFrame:
    """``conversation``, ``perspective``, ``part``, ``n_turns``, ``n_trained``, ``rendered``, ``mask_starts``, ``mask_ends``.

    One row for each participant, in part 0. ``mask_starts`` and ``mask_ends`` are offsets in code points into ``rendered``, from
    0, the end excluded. Turns are in order of number, then speaker and text, a null number or speaker first, so ties and repeated
    turns have one order and all stay. A null text is an empty message. A turn without a speaker is rendered as an unnamed user;
    a conversation without any participant gives no row, as does a null conversation.

    With ``part_bytes`` a part ends after the turn that reaches a multiple of so many rendered bytes. No turn is cut or left out,
    numbers of parts rise with the turns, and a later part opens with a copy of the last system turn before it, which
    ``n_turns`` doesn't count.
    """
    said = turns.select(
        F.col(conversation).alias("__conversation"),
        F.col(turn).cast("long").alias("__turn"),
        F.col(speaker).cast("string").alias("__speaker"),
        escaped(F.col(text)).alias("__text"),
    )
    name = escaped(F.col("__speaker"))
    is_self = F.coalesce(F.col("__speaker") == F.col("__self"), F.lit(False))
    head = (
        F.when(is_self, F.lit(f"{OPEN}assistant\n"))
        .when(F.col("__speaker") == system, F.lit(f"{OPEN}system\n"))
        .when(F.col("__speaker").isNull(), F.lit(f"{OPEN}user\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), name, F.lit("\n")))
    )
    dialogue = ("__conversation", "__self")
    order = [F.col(c).asc_nulls_first() for c in ("__turn", "__speaker", "__text")]
    # A system message is the same in every perspective, and copies of it have no part in the mask.
    rows = said.join(participants(turns, conversation, speaker, system), "__conversation").select(
        *dialogue,
        F.row_number().over(Window.partitionBy(*dialogue).orderBy(*order)).alias("at"),
        F.concat(head, "__text", F.lit(f"{CLOSE}\n")).alias("message"),
        F.length(head).alias("head"),
        is_self.alias("trained"),
        F.coalesce(F.col("__speaker") == system, F.lit(False)).alias("context"),
    )
    if part_bytes is None:
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    else:
        before = Window.partitionBy(*dialogue).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        size = F.coalesce(F.sum(F.octet_length("message").cast("long")).over(before), F.lit(0))
        in_force = F.last(F.when(F.col("context"), F.col("message")), ignorenulls=True).over(before)
        rows = rows.withColumns({"part": F.floor(size / part_bytes), "in_force": in_force})
        opens = F.row_number().over(Window.partitionBy(*dialogue, "part").orderBy("at")) == 1
        opening = F.when(opens & (F.col("part") > 0) & ~F.col("context"), F.coalesce("in_force", F.lit(""))).otherwise("")
        rows = rows.withColumn("opening", opening).withColumns(
            {"head": F.col("head") + F.length("opening"), "message": F.concat("opening", "message")}
        )
    upto = Window.partitionBy(*dialogue, "part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.length("message").cast("long")).over(upto)
    placed = rows.select(
        *dialogue,
        "part",
        F.struct(
            "at", "message", "trained",
            (end - F.length("message") + F.col("head")).alias("begin"),
            (end - 1).alias("end"),  # the line feed is no part of the turn
        ).alias("message"),
    )
    grouped = placed.groupBy(*dialogue, "part").agg(F.sort_array(F.collect_list("message")).alias("messages"))
    trained = F.filter("messages", lambda m: m["trained"])
    return grouped.withColumn("trained", trained).select(
        F.col("__conversation").alias(conversation),
        F.col("__self").alias("perspective"),
        "part",
        F.size("messages").cast("long").alias("n_turns"),
        F.size("trained").cast("long").alias("n_trained"),
        F.array_join("messages.message", "").alias("rendered"),
        F.col("trained.begin").alias("mask_starts"),
        F.col("trained.end").alias("mask_ends"),
    )
