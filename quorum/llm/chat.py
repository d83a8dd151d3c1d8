"""Chat formatting by prefix-target expansion (operator 1).

Every assistant turn becomes one example: all turns before it as context, its
own text as the only trainable span.  Turns after the last assistant turn (or
of a conversation without one) are kept in one further example that trains on
nothing, so the examples of a conversation hold all of it.

Template: ``<s>`` and ``</s>`` around a turn, ``[INST]`` and ``[/INST]`` around
every turn that is not the assistant's; inside, the role, a line feed and the
text.  These control strings, and the escape character, are replaced inside
roles and texts by a backslash and a letter, so a text can never open or close
a turn and :func:`read_back` restores it exactly.

Everything is DataFrame functions.  An example is one row that holds its whole
context, so a conversation has to fit in a row (2 GB of text); a conversation
of n turns makes output quadratic in n, which is what the expansion asks for.

Defined results: null role or text counts as empty; a null turn sorts first;
rows with the same turn are ordered by role, then text, and repeated rows are
turns of their own; rows with a null conversation id form one conversation; an
empty table gives no example; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
BACKSLASH = ("\\", "\\b")
#: Control string and what stands for it inside a text.
CONTROL = (("</s>", "\\e"), ("<s>", "\\s"), ("[/INST]", "\\o"), ("[INST]", "\\i"))
LINE_FEED = ("\n", "\\n")


def escape(text: Column, pairs=CONTROL) -> Column:
    for plain, code in (BACKSLASH, *pairs):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs=CONTROL) -> Column:
    for plain, code in (*pairs, BACKSLASH):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _head(role: Column, reply: Column) -> Column:
    """What precedes a turn's text."""
    return F.concat(F.when(reply, F.lit("<s>")).otherwise(F.lit("<s>[INST]")),
                    escape(role, (*CONTROL, LINE_FEED)), F.lit("\n"))


def examples(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv_id, example, n_turns, formatted, loss_start, loss_length): one row per assistant turn and tail.

    ``loss_start`` counts code points of ``formatted`` from 0; a tail has loss_length 0 and
    loss_start null.
    """
    said = F.coalesce(F.col(role).cast("string"), F.lit(""))
    reply = said == ASSISTANT
    one = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).cast("long").alias("turn"), said.alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    parts = whole.select(
        "conv_id",
        F.transform("t", lambda t: _head(t["role"], t["role"] == ASSISTANT)).alias("heads"),
        F.transform("t", lambda t: escape(t["text"])).alias("bodies"),
        F.transform("t", lambda t: F.when(t["role"] == ASSISTANT, F.lit("</s>")).otherwise(F.lit("[/INST]</s>"))).alias("tails"),
        F.transform("t", lambda t: t["role"] == ASSISTANT).alias("replies"),
    )
    targets = parts.withColumn(
        "at", F.explode(F.filter(F.sequence(F.lit(0), F.size("replies") - 1),
                                 lambda i: F.get("replies", i) | (i == F.size("replies") - 1))))
    # Turns 0..at, each as head, body and tail; the context ends after the target's head.
    turn_text = F.transform(F.sequence(F.lit(0), F.col("at")),
                            lambda i: F.concat(F.get("heads", i), F.get("bodies", i), F.get("tails", i)))
    trains = F.get("replies", F.col("at"))
    length = F.length(F.get("bodies", F.col("at")))
    return targets.select(
        "conv_id", F.col("at").alias("example"), (F.col("at") + 1).alias("n_turns"),
        F.array_join(turn_text, "").alias("formatted"), trains.alias("trains"),
        length.alias("length"), F.length(F.get("tails", F.col("at"))).alias("after"),
    ).select(
        "conv_id", "example", "n_turns", "formatted",
        F.when(F.col("trains"), F.length("formatted") - F.col("after") - F.col("length")).alias("loss_start"),
        F.when(F.col("trains"), F.col("length")).otherwise(F.lit(0)).alias("loss_length"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    bare = F.regexp_replace(formatted, r"<s>|\[/?INST\]", "")
    turns = F.split(bare, "</s>", -1)
    return F.transform(
        F.slice(turns, 1, F.size(turns) - 1),
        lambda t: F.struct(
            unescape(F.substring_index(t, "\n", 1), (*CONTROL, LINE_FEED)).alias("role"),
            unescape(F.substring(t, F.locate("\n", t) + 1, F.length(t))).alias("text"),
        ),
    )


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The trainable text, unescaped; empty for a tail."""
    return F.when(start.isNotNull(), unescape(F.substring(formatted, start + 1, length))).otherwise(F.lit(""))


def digests(ex: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples alone: turn and loss digests."""
    per = ex.select(
        "conv_id",
        F.struct("example", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss")).alias("l"),
        F.length("formatted").cast("long").alias("chars"),
        F.struct("example", "formatted").alias("whole"),
    )
    conv = per.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"), F.max("whole")["formatted"].alias("formatted"),
    ).withColumn("turns", read_back(F.col("formatted")))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conv.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
