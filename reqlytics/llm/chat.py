"""Chat formatting: every assistant turn becomes an example of its own, with all turns before it as context.

A conversation's turns are written one after the other, each as ``<|im_start|>role\\ntext<|im_end|>\\n``. The
example of an assistant turn is that text up to and with the turn; only the reply is trainable, and
``loss_start`` and ``loss_chars`` say where it stands (code points). Turns after the last assistant turn have
no reply to learn; they are kept in one more row without a trainable part, so the output holds every turn.

Control strings inside texts are escaped reversibly: between ``<`` and ``|`` one backslash is put in front of
those that already stand there, so no text holds ``<|``, and reading back takes one away. Line ends and
backslashes of a role are escaped too, since a line end closes the role.

All of it is DataFrame functions. A conversation is gathered by its id (a text that is to be formatted as one
must be in one place); turns that repeat stay, ordered by turn, role and text. Results: null texts and roles
are empty, a null turn stands first, rows without conv_id are one conversation, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"), escaped(text), F.lit(END + "\n"))


def turns_in_order(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``turns``, an array of (turn, role, text) in order."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def expand(rows: DataFrame) -> DataFrame:
    """Examples of all conversations: ``conv_id``, ``example`` (from 1), ``formatted``, ``loss_start`` and
    ``loss_chars`` (the trainable part, from 0), ``is_rest`` (turns after the last reply, nothing trainable)."""
    written = turns_in_order(rows).select(
        "conv_id",
        F.transform("turns", lambda t: formatted_turn(t["role"], t["text"])).alias("parts"),
        F.transform("turns", lambda t: F.when(t["role"] == ASSISTANT, F.length(escaped(t["text"])))).alias("loss"),
    )
    number = F.sequence(F.lit(1), F.size("parts"))
    picked = F.filter(number, lambda i: F.element_at("loss", i).isNotNull() | (i == F.size("parts")))
    examples = written.select("conv_id", "parts", "loss", F.posexplode(picked).alias("place", "last"))
    text = F.array_join(F.slice("parts", 1, F.col("last")), "")
    chars = F.element_at("loss", F.col("last"))
    return examples.select(
        "conv_id",
        (F.col("place") + 1).alias("example"),
        text.alias("formatted"),
        F.when(chars.isNotNull(), F.length(text) - F.length(F.lit(END + "\n")) - chars).alias("loss_start"),
        F.coalesce(chars, F.lit(0)).alias("loss_chars"),
        chars.isNull().alias("is_rest"),
    )


def parsed_turns(formatted: Column) -> Column:
    """Turns of a formatted text, read back: an array of (role, text)."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    bodies = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    tail = len(END) + 1

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        return F.struct(
            unescaped_role(F.substring(piece, F.lit(1), line - 1)).alias("role"),
            unescaped(F.substring(piece, line + 1, F.length(piece) - line - tail)).alias("text"),
        )

    return F.transform(bodies, turn)


def trainable(examples: DataFrame) -> Column:
    """The text under an example's loss mask, read back; empty where nothing is trainable."""
    start = F.coalesce(F.col("loss_start"), F.lit(0)) + 1
    return unescaped(F.substring(F.col("formatted"), start, F.col("loss_chars")))


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns of the longest, and the trainable parts in order."""
    examples = expand(rows)
    read = examples.select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        trainable(examples).alias("reply"),
        "formatted",
    )
    whole = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sum("chars").alias("formatted_chars"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("example", "reply"))), lambda e: e["reply"]), ""
        ).alias("loss"),
    )
    turns = whole.withColumn("turns", parsed_turns(F.col("longest")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
