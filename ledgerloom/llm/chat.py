"""Chat formatting with Spark expressions only: sorted turn structs, merged turns, reversible escapes, loss mask.

A conversation becomes one string. Adjacent turns of one role are merged into one block::

    <turn assistant>first text<part/>second text</turn>

``<``, ``>`` and the backslash never stand in an escaped text or role, so every ``<`` in the output is a mark of the
template, whatever the texts say, and the original turns can be read back.

The loss mask is kept as segments: the formatted string cut into pieces, each with a flag. The flagged pieces are
exactly the escaped texts of the learned role, without marks or separators.

One shuffle by conversation. What meets in one task is one conversation, which is one value of the result anyway;
all steps on it are linear in its length.

Defined results: a null text or role is an empty one; turns are ordered by turn number (null first), ties by role,
then text; repeated rows are repeated turns; rows without a conversation id form one conversation; an empty table
gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, NAMED, PART, CLOSE = "<turn ", ">", "<part/>", "</turn>\n"
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    for plain, mark in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    """Undo :func:`escaped`: a doubled backslash is the only mark that starts with another mark's first character."""
    backslash, *others = ESCAPES

    def piece(p: Column) -> Column:
        for plain, mark in others:
            p = F.replace(p, F.lit(mark), F.lit(plain))
        return p

    # Two characters in a literal pattern of Java's regular expressions.
    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), backslash[0])


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``segments`` (array of text, loss)."""
    said = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    gathered = turns.groupBy(F.col(conversation).alias("_conversation")).agg(
        F.array_sort(F.collect_list(said)).alias("_turns")
    )
    last = F.size("_turns") - 1

    def role_at(i: Column) -> Column:
        return F.get("_turns", i)["role"]

    # A run of one role begins where the role differs from the turn before.
    starts = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    runs = gathered.withColumn("_starts", starts)

    def merged(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_starts", k + 1), last + 1)
        own = F.slice("_turns", start + 1, end - start)
        return F.struct(role_at(start).alias("role"), F.transform(own, lambda t: escaped(t["text"])).alias("texts"))

    blocks = runs.select("_conversation", F.transform("_starts", merged).alias("_blocks"))

    def segment(piece: Column, loss: Column) -> Column:
        return F.struct(piece.alias("text"), loss.alias("loss"))

    def pieces(block: Column) -> Column:
        """Mark, text, mark, text, ..., mark of one block."""
        learn = block["role"] == learned
        opened = F.concat(F.lit(OPEN), escaped(block["role"]), F.lit(NAMED))
        texts = F.transform(
            block["texts"],
            lambda t, i: F.array(
                segment(F.when(i == 0, opened).otherwise(F.lit(PART)), F.lit(False)), segment(t, learn)
            ),
        )
        return F.concat(F.flatten(texts), F.array(segment(F.lit(CLOSE), F.lit(False))))

    return blocks.select(
        F.col("_conversation").alias(conversation), F.flatten(F.transform("_blocks", pieces)).alias("segments")
    ).select(conversation, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def turns_of(formatted: Column) -> Column:
    """The original turns, as an array of (role, text), read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def parts(block: Column) -> Column:
        named = F.locate(NAMED, block)
        role = unescaped(F.substring(block, F.lit(len(OPEN) + 1), named - len(OPEN) - 1))
        texts = F.split(F.substring(block, named + 1, F.length(block)), PART)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, parts))


def learned_texts(segments: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"]))
