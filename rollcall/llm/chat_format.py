"""Training examples from conversations: every assistant turn with all turns before it.

Built-in functions only. A turn is written as ``<|im_start|>role``, line feed, text,
``<|im_end|>``, line feed. Inside roles and texts a backslash goes between the two characters
of ``<|`` (and one more where there already are some), so that no control string can occur
there; taking one away gives the original back. In roles, backslash and line feed are written
as two characters as well, because a line feed ends the role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _role(role: Column) -> Column:
    doubled = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return escape(F.replace(doubled, F.lit("\n"), F.lit("\\n")))


def _role_back(role: Column) -> Column:
    """Backslashes were doubled, so one before ``n`` stands for a line feed only outside pairs;
    pairs are set aside as line feeds, of which there are none, meanwhile.
    """
    aside = F.replace(unescape(role), F.lit("\\\\"), F.lit("\n"))
    parted = F.split(aside, r"\\n", -1)
    return F.array_join(F.transform(parted, lambda p: F.replace(p, F.lit("\n"), F.lit("\\"))), "\n")


def expand(conversations: DataFrame) -> DataFrame:
    """One row per assistant turn: ``conv_id``, ``target`` (its place among the turns, from 1),
    ``text`` (all turns up to and including it, formatted), ``loss_start`` and ``loss_end``
    (the reply within ``text``, in code points; nothing else is trainable).

    A conversation that does not end in an assistant turn gives one more row with all its turns
    and an empty mask, so that no turn is lost. Turns go by ``turn`` (NULL first), ties by role
    and text; repeated rows are turns each. NULL roles and texts count as empty; NULL ``conv_id``
    is one conversation. No rows give no rows. Other columns are not read. All turns of one
    conversation meet in one task, as the formatted text of its last example must hold them.
    """
    turns = F.sort_array(
        F.collect_list(
            F.struct(
                "turn",
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            )
        )
    )
    written = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == TRAINED).alias("trained"),
            F.concat(F.lit(START), _role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    # Stored as strings before examples are cut, so that a turn is escaped once, not once more
    # for every example that it precedes.
    formatted = (
        conversations.groupBy("conv_id")
        .agg(turns.alias("turns"))
        .select("conv_id", written.alias("turns"))
        .select(
            "conv_id",
            F.col("turns.trained").alias("trained"),
            F.transform(
                "turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))
            ).alias("whole"),
            F.transform("turns", lambda t: F.char_length(t["body"])).alias("body_chars"),
        )
    )
    return (
        formatted.select("conv_id", "whole", "body_chars", F.posexplode("trained"))
        .filter(F.col("col") | (F.col("pos") == F.size("whole") - 1))
        .select(
            "conv_id",
            (F.col("pos") + 1).alias("target"),
            F.col("col").alias("trained"),
            F.array_join(F.slice("whole", F.lit(1), F.col("pos") + 1), "").alias("text"),
            F.element_at("body_chars", F.col("pos") + 1).alias("chars"),
        )
        .select(
            "conv_id",
            "target",
            "text",
            (
                F.char_length("text")
                - F.when(F.col("trained"), F.col("chars") + len(END)).otherwise(0)
            ).alias("loss_start"),
            (F.char_length("text") - F.when(F.col("trained"), len(END)).otherwise(0)).alias(
                "loss_end"
            ),
        )
    )


def read_turns(text: Column) -> Column:
    """Roles and texts, back from a formatted text."""
    parts = F.split(text, F.lit(r"<\|im_end\|>\n"), -1)
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            _role_back(
                F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)
            ).alias("role"),
            unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )


def digest(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted examples alone: ``n_turns``,
    ``turns_sha256`` (role, line feed, text, line feed per turn), ``loss_chars`` and
    ``loss_sha256`` (all text under the masks, unescaped, in order), ``formatted_chars`` (of all
    examples together).
    """
    reply = unescape(
        F.substr("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    )
    read_back = (
        examples.select("conv_id", "target", "text", reply.alias("reply"))
        .groupBy("conv_id")
        .agg(
            F.max_by("text", "target").alias("whole"),
            F.sort_array(F.collect_list(F.struct("target", "reply"))).alias("replies"),
            F.sum(F.char_length("text")).alias("formatted_chars"),
        )
        .select(
            "conv_id",
            read_turns(F.col("whole")).alias("turns"),
            F.array_join("replies.reply", "").alias("loss"),
            "formatted_chars",
        )
    )
    plain = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
