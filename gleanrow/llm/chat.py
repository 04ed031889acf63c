"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is written ``<|turn|>role<|says|>text<|end|>``. Every assistant turn becomes one
example: all turns before it as context, then that reply, the only text under the loss
mask. Turns after the last reply are in no such example, so a conversation that ends with
them (or has no reply at all) gets one more example without a trainable span.

Inside roles and texts each ``<``, ``[`` and backslash is followed by a backslash, so no
control string, of this template or of the common ``[INST]``/``</s>`` ones, can stand in
a text, and removing those backslashes gives the text back.

Edge cases: null text or role is the empty string; a row without conv_id is a conversation of
its own turn alone; turns are ordered by turn, nulls first, ties by role, then text; repeated rows
are repeated turns; an empty table gives an empty result; other columns are ignored. A conversation
must fit a task: its examples repeat its turns, as prefix-target expansion means them to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
TURN_PATTERN = r"(?s)<\|turn\|>(.*?)<\|says\|>(.*?)<\|end\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, alone (tells rows without conv_id apart), turns array<struct<role, head, body>>, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t")
    rows = conversations.select("conv_id", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone"), turn)
    lists = rows.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return lists.select(
        "conv_id",
        "alone",
        F.transform(
            "ts",
            lambda t: F.struct(
                t["role"].alias("role"),
                F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS)).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        ).alias("turns"),
    )


def expand(conversations: DataFrame, trainable: str = "assistant") -> DataFrame:
    """Examples: conv_id, alone, example int (0..), formatted string, loss_start and loss_end int.

    The loss span counts code points of ``formatted``; both are null in the closing example
    that only carries turns after the last trainable one.
    """
    lists = format_turns(conversations)
    # cut[i]: the conversation up to and with turn i
    at = lists.select(
        "conv_id",
        "alone",
        "turns",
        F.filter(
            F.sequence(F.lit(0), F.size("turns") - 1),
            lambda i: (F.get("turns", i)["role"] == trainable) | (i == F.size("turns") - 1),
        ).alias("ends"),
    )
    one = at.select("conv_id", "alone", "turns", F.posexplode("ends").alias("example", "end"))
    said = lambda t: F.concat(t["head"], t["body"], F.lit(END))
    last = F.get("turns", F.col("end"))
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("end")), said), "")
    start = F.length("context") + F.length("head")
    learns = F.col("role") == trainable
    parts = [context.alias("context"), *(last[c].alias(c) for c in ("role", "head", "body"))]
    return one.select("conv_id", "alone", "example", *parts).select(
        "conv_id",
        "alone",
        "example",
        F.concat("context", "head", "body", F.lit(END)).alias("formatted"),
        F.when(learns, start).alias("loss_start"),
        F.when(learns, start + F.length("body")).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted example."""
    roles = F.regexp_extract_all(formatted, F.lit(TURN_PATTERN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(TURN_PATTERN), F.lit(2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask; empty where there is none."""
    return F.coalesce(unescape(F.substring(formatted, start + 1, end - start)), F.lit(""))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples alone: turns, loss text and sizes.

    The last example holds every turn; the masked text of all of them, in order, is the loss.
    """
    last = F.max_by("formatted", "example").alias("whole")
    loss = F.sort_array(F.collect_list(F.struct("example", read_loss(F.col("formatted"), F.col("loss_start"),
        F.col("loss_end")).alias("text"))))
    per = examples.groupBy("conv_id", "alone").agg(last, loss.alias("loss"), F.sum(F.length("formatted")).alias("formatted_chars"))
    out = per.select("conv_id", read_turns(F.col("whole")).alias("turns"),
        F.array_join(F.transform("loss", lambda x: x["text"]), "").alias("loss"), "formatted_chars")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
    )
