"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted by (turn, role,
text).  Adjacent turns of one role become one block, cut out of the sorted
array by the places where the role changes; every step is linear in the
number of turns.

Template of a block:  <s>[role]text[TURN]text</s> and a newline.  Inside roles
and texts '&', '<', '[' and ']' are written as entities, so no control string
can occur in them and reading back needs no look-ahead.  The loss mask covers
the escaped texts of the assistant's turns, without the marks between them.

A formatted conversation is one value: its size is that of the conversation,
which no split can lessen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.llm.arrays import running_ends, with_cutter

OPEN, HEAD_END, TURN_MARK, CLOSE = "<s>[", "]", "[TURN]", "</s>\n"
#: Characters that control strings are made of, and what stands for them in texts.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("]", "&#93;"))
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    for plain, entity in ENTITIES:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescaped(text: Column) -> Column:
    for plain, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, formatted, loss_spans): spans are [start, end) in code points of the formatted text.

    Nulls: a null role or text is empty, a null turn sorts first, a null
    conversation id is a conversation of its own.  Equal turns sort by role,
    then text; repeated rows stay as turns of their own.  An empty table gives
    no rows.  Other columns take no part.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    chats = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    role_at = lambda i: F.col("turns")[i]["role"]
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role_at(i) != role_at(F.greatest(i - 1, F.lit(0)))))
    chats = chats.withColumn("starts", starts)
    blocks = F.transform(
        F.col("starts"),
        lambda s, k: F.struct(
            role_at(s).alias("role"),
            F.transform(
                F.slice("turns", s + 1, F.coalesce(F.get(F.col("starts"), k + 1), F.size("turns")) - s),
                lambda t: escaped(t["text"]),
            ).alias("texts"),
        ),
    )
    chats = chats.select("conv_id", blocks.alias("blocks"))
    head = lambda b: F.concat(F.lit(OPEN), escaped(b["role"]), F.lit(HEAD_END))
    written = F.transform(
        "blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], TURN_MARK), F.lit(CLOSE))
    )
    # One (length before the text, length of the text, length after it, learned) per turn, in order.
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, i: F.struct(
                    F.when(i == 0, F.length(head(b))).otherwise(F.lit(len(TURN_MARK))).cast("long").alias("before"),
                    F.length(t).cast("long").alias("own"),
                    F.when(i == F.size(b["texts"]) - 1, F.lit(len(CLOSE))).otherwise(F.lit(0)).cast("long").alias("after"),
                    (b["role"] == LEARNED_ROLE).alias("learned"),
                ),
            ),
        )
    )
    chats = chats.select("conv_id", F.array_join(written, "").alias("formatted"), pieces.alias("pieces"))
    chats = chats.withColumn("ends", running_ends(F.transform("pieces", lambda p: p["before"] + p["own"] + p["after"])))
    spans = F.zip_with(
        "pieces",
        "ends",
        lambda p, e: F.when(
            p["learned"], F.struct((e - p["after"] - p["own"]).alias("start"), (e - p["after"]).alias("end"))
        ),
    )
    return chats.select("conv_id", "formatted", F.filter(spans, lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted conversation holds, a turn each."""
    blocks = F.filter(F.split(formatted, r"\Q" + CLOSE.strip() + r"\E\n", -1), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring(b, F.locate(HEAD_END, b) + len(HEAD_END), F.length(b)), r"\Q" + TURN_MARK + r"\E", -1),
                lambda t: F.struct(
                    unescaped(F.substring(b, F.lit(len(OPEN) + 1), F.locate(HEAD_END, b) - len(OPEN) - 1)).alias("role"),
                    unescaped(t).alias("text"),
                ),
            ),
        )
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    learned = lambda cut: F.transform(spans, lambda s: unescaped(cut(s["start"], s["end"] - s["start"])))
    return with_cutter(formatted, lambda cut: F.array_join(learned(cut), ""))
