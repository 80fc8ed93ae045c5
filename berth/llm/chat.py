"""Chat formatting by perspective rotation, in DataFrame operations only.

Every participant of a conversation gets a rendering of it in which that participant is the
assistant and the others are named users; turns of a system role stay what they are. A rendering
is a row for each turn, so that a conversation of any length, or one that holds a third of all
turns, is never gathered in a task; read in the order of (turn, role, text), the ``rendered``
texts make up the dialogue. The mask of a row says which of its characters are to be learned:
those of the assistant's text and of the mark that ends it, none in the turns of others.

Defined results: a null text is an empty turn; a null or empty role speaks as UNNAMED; null
conv_ids are one conversation and null turns come first; turns that repeat are rendered as often
as they stand there; marks of the format inside a text are broken by a blank, so that no text
can open or close a turn; blanks and signs in names become ``_``; a conversation of system turns
only has no participant and no rendering. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
UNNAMED = "unnamed"


def speaker_of(role: str) -> Column:
    name = F.regexp_replace(F.trim(F.col(role)), r"[^0-9A-Za-z\x{80}-\x{10FFFF}_.-]", "_")
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(UNNAMED))


def harmless(text: str) -> Column:
    """The text with the format's marks broken."""
    return F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, turn, role, name, rendered, learn_from, learn_to): for each
    participant, each turn as it looks from there; characters learn_from to learn_to (from 0, the
    end not included) are learned."""
    said = turns.select(
        "conv_id", "turn", speaker_of("role").alias("speaker"), harmless("text").alias("text")
    )
    participants = (
        said.where(F.col("speaker") != SYSTEM)
        .select(F.col("conv_id").alias("own_conv"), F.col("speaker").alias("perspective"))
        .distinct()
    )
    seen = said.join(participants, F.col("conv_id").eqNullSafe(F.col("own_conv")))
    mine = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(mine, "assistant").otherwise("user")
    shown = seen.select(
        "conv_id", "perspective", "turn", role.alias("role"),
        F.when(~mine & (F.col("speaker") != SYSTEM), F.col("speaker")).alias("name"), "text",
    )
    head = F.concat(
        F.lit(OPEN), "role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n")
    )
    learned = F.col("role") == "assistant"
    start = F.length(head)
    return shown.select(
        "conv_id", "perspective", "turn", "role", "name",
        F.concat(head, "text", F.lit(CLOSE + "\n")).alias("rendered"),
        F.when(learned, start).otherwise(0).cast("int").alias("learn_from"),
        F.when(learned, start + F.length("text") + len(CLOSE)).otherwise(0).cast("int").alias("learn_to"),
    )
