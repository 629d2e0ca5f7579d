"""Chat formatting: turns of a conversation as one marked text with a loss mask, and back.

Template. Neighbouring turns of one role make one message: ``<|im_start|>role\\n``, the texts with
``<|turn|>`` between, ``<|im_end|>\\n``. Inside roles and texts ``&`` is written ``&amp;`` and ``<|``
is written ``&lt;|``, in roles a line feed ``&#10;``; so no text can hold a marker, and
undoing the two gives the text back.

Everything is Spark expressions. The rows of a conversation meet in one row, as the output is one text.
Null roles and texts are empty, a null conversation is a conversation, turns with equal numbers are
ordered by role, then text, null numbers come first, repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TURN, END = "<|im_start|>", "<|turn|>", "<|im_end|>\n"


def _replaced(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    return _replaced(_replaced(text, "&", "&amp;"), "<|", "&lt;|")


def unescaped(text: Column) -> Column:
    return _replaced(_replaced(_replaced(text, "&#10;", "\n"), "&lt;", "<"), "&amp;", "&")


def formatted(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """``(conv_id, segments, formatted)`` from ``(conv_id, turn, role, text)``; other columns go.

    ``segments`` is an array of ``(text, loss)`` that joined gives ``formatted``; ``loss`` marks the
    texts of the role ``learned``, without markers.
    """
    # Sorted on the raw strings, so that the order does not depend on the escapes.
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "turn",
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )

    def marked(all_turns: Column) -> Column:
        def pieces(turn: Column, i: Column) -> Column:
            earlier = F.get(all_turns, i - 1)["role"]
            later = F.get(all_turns, i + 1)["role"]
            role = _replaced(escaped(turn["role"]), "\n", "&#10;")
            opens = F.when(
                earlier.eqNullSafe(turn["role"]), F.lit(TURN)
            ).otherwise(F.concat(F.lit(START), role, F.lit("\n")))
            closes = F.when(later.eqNullSafe(turn["role"]), F.lit("")).otherwise(F.lit(END))
            return F.array(
                F.struct(opens.alias("text"), F.lit(False).alias("loss")),
                F.struct(
                    escaped(turn["text"]).alias("text"), (turn["role"] == learned).alias("loss")
                ),
                F.struct(closes.alias("text"), F.lit(False).alias("loss")),
            )

        return F.flatten(F.transform(all_turns, pieces))

    # The one-element array binds the turns once for all the lookups inside.
    segments = F.transform(F.array("turns"), marked)[0]
    return collected.select("conv_id", segments.alias("segments")).select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def turns_of(text: Column) -> Column:
    """The array of ``(role, text)`` that a formatted text was made from."""
    messages = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda m: m != "")

    def parts(message: Column) -> Column:
        head_end = F.instr(message, "\n")
        role = unescaped(F.substring(message, F.lit(len(START) + 1), head_end - len(START) - 1))
        body = F.substring(message, head_end + 1, F.char_length(message))
        return F.transform(
            F.split(body, r"<\|turn\|>"),
            lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")),
        )

    return F.flatten(F.transform(messages, parts))


def digests(rows: DataFrame) -> DataFrame:
    """What the outputs of ``formatted`` say, read back from them."""
    read = rows.select(
        "conv_id",
        turns_of(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform(
                F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])
            ),
            "",
        ).alias("learned"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
