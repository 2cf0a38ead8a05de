"""Chat formatting: every assistant turn becomes an example of its own.

An example holds all preceding turns as context and one assistant reply as
target; only the reply is under the loss mask.  A turn is written as

    <|im_start|>role NEWLINE text<|im_end|> NEWLINE

Control strings inside roles and texts are escaped reversibly: each ``<|``,
with any backslashes between the two signs, gets one backslash more, so an
escaped text holds no ``<|`` and loses exactly one backslash on the way
back.  A line break in a role is written as a control string of its own.

Turns after the last assistant turn (or of a conversation without one) form
a last example without target, so the output holds every turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|break|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _turn(role: Column, text: Column) -> Column:
    head = F.replace(escape(role), F.lit("\n"), F.lit(BREAK))
    return F.concat(F.lit(START), head, F.lit("\n"), escape(text), F.lit(END))


def format_chats(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``example``, ``formatted``, ``loss_start``, ``loss_length``: one row per example.

    Turns go by ``turn`` (null first); of turns with one number, by role and
    text, repeated rows each counting.  Null texts and roles read as empty.
    Rows with a null ``conv_id`` form one conversation.  example counts from
    0; loss_start and loss_length (characters of ``formatted``) mark the
    reply that is trained on, 0 and 0 in an example without target.  Other
    columns are ignored; an empty table gives an empty table.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role", "text"))).alias("turns"))
    last = F.size("turns") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: (F.get(F.col("turns.role"), i) == "assistant") | (i == last))
    examples = turns.withColumn("written", F.transform("turns", lambda t: _turn(t["role"], t["text"]))).select(
        "conv_id", "turns", "written", F.posexplode(targets).alias("example", "at")
    )
    reply = escape(F.get(F.col("turns.text"), F.col("at")))
    trained = F.get(F.col("turns.role"), F.col("at")) == "assistant"
    return examples.select(
        "conv_id", "example", F.array_join(F.slice("written", F.lit(1), F.col("at") + 1), "").alias("formatted"),
        F.length(reply).alias("reply"), trained.alias("trained"),
    ).select(
        "conv_id", "example", "formatted",
        F.when(F.col("trained"), F.length("formatted") - F.col("reply") - len(END)).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("trained"), F.col("reply")).otherwise(0).cast("long").alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) written in an example."""
    pieces = F.filter(F.split(formatted, r"\Q" + START + r"\E"), lambda p: p != "")
    body = lambda p: p.substr(F.lit(1), F.length(p) - len(END))

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        return F.struct(
            unescape(F.replace(head, F.lit(BREAK), F.lit("\n"))).alias("role"),
            unescape(body(p).substr(F.length(head) + 2, F.length(p))).alias("text"),
        )

    return F.transform(pieces, turn)


def read_loss(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask as it was before escaping."""
    return unescape(formatted.substr((start + 1).cast("int"), length.cast("int")))
