"""Conversations as one training text with a loss mask, in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SPLIT, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# first characters of the template's own marks and of other common control strings: <|..., <s>, </s>, [INST], [/INST]
_CONTROL = r"\\|<(?=\||/?s>)|\[(?=/?INST\])"


def escaped(text: Column) -> Column:
    """Text without any control string: a backslash follows the first character of each, and every backslash."""
    return F.regexp_replace(text, _CONTROL, r"$0\\")


def _role(role: Column) -> Column:
    """A role on one line: no escaped text holds ``<\\n>`` with a single backslash, so a newline can be written so."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n>"))


def unescaped(text: Column) -> Column:
    """The exact text that ``escaped`` was given: a pair of backslashes is one, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(
    rows: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """``conv_id, formatted, segments`` per conversation.

    Turns are sorted as an array of structs (turn, role, text), adjacent turns of one role are merged into a
    block by an array aggregation, and a block reads ``<|im_start|>role\\ntext<|im_end|>\\n``; the texts of a
    merged block are parted by ``<|im_sep|>``. Control strings inside roles and texts and newlines in roles are escaped, so ``parsed``
    gives back every turn exactly. ``formatted`` is the concatenation of ``segments.text``;
    ``segments.loss`` is the loss mask: true for exactly the texts of role ``trained``.

    NULL text and NULL role count as empty. A NULL turn comes first; turns with equal numbers go by role, then
    text; repeated rows stay as turns of their own. Rows with NULL id are one conversation with NULL id. Other
    columns are not read. An empty table gives an empty result.
    """
    turn = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = rows.select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )
    # a turn with the role before and after it: a block opens where the role changes
    roles = sorted_turns.withColumn("before", F.concat(F.array(F.lit(None).cast("string")), "turns.role")).withColumn(
        "after", F.concat(F.slice("turns.role", F.lit(2), F.size("turns")), F.array(F.lit(None).cast("string")))
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def pieces(z: Column) -> Column:
        role, plain = z["turns"]["role"], F.lit(False)
        opening = F.when(role.eqNullSafe(z["before"]), F.lit(SPLIT)).otherwise(F.concat(F.lit(START), _role(role), F.lit("\n")))
        closing = F.when(role.eqNullSafe(z["after"]), F.lit("")).otherwise(F.lit(END + "\n"))
        return F.array(
            segment(opening, plain), segment(escaped(z["turns"]["text"]), role == F.lit(trained)), segment(closing, plain)
        )

    zipped = F.arrays_zip("turns", F.slice("before", F.lit(1), F.size("turns")).alias("before"), "after")
    merged = roles.select("conv_id", F.flatten(F.transform(zipped, pieces)).alias("segments"))
    return merged.select("conv_id", F.concat_ws("", "segments.text").alias("formatted"), "segments")


def parsed(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` read back from a formatted text alone."""
    parts = F.split(formatted, r"<\|im_start\|>")
    blocks = F.slice(parts, F.lit(2), F.size(parts))

    def turns(block: Column) -> Column:
        role = unescaped(F.replace(F.substring_index(block, "\n", 1), F.lit("<\\n>"), F.lit("\n")))
        body = F.regexp_replace(block, r"(?s)\A[^\n]*\n|<\|im_end\|>\n\z", "")
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return unescaped(F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"])))
