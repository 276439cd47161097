"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are the
context, and only that reply is trainable. A conversation whose last turn is not
an assistant's gets one closing example without a target, so the output holds
every turn.

Template: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` for each turn. Control strings
inside texts are escaped reversibly: ``<`` followed by any backslashes and ``|``
gets one backslash more, so an escaped text never holds ``<|``; unescaping takes
that backslash away. Roles are URL-encoded, which also hides line breaks.

An example has ``formatted`` and the loss mask as one character span
[loss_start, loss_start + loss_length) that covers the escaped reply without its
markers.

Defined results: a null text is the empty text and a null role the empty role;
turns are ordered by (turn, role, text), null turns first, and repeated rows are
turns of their own; rows with a null conv_id form one conversation with a null
id; a conversation without an assistant turn has the closing example alone and an
empty loss; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.llm.quality import bind

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as one row."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def examples(rows: DataFrame) -> DataFrame:
    """(conv_id, example, n_turns, formatted, loss_start, loss_length): one row
    for each assistant turn, and the closing row where one is needed."""
    shown = conversations(rows).select(
        "conv_id", F.transform("turns", lambda t: F.struct(
            F.concat(F.lit(OPEN), F.url_encode(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
            (t["role"] == TARGET_ROLE).alias("target"))).alias("turns"))
    size = F.size("turns")
    places = F.filter(F.sequence(F.lit(1), size), lambda i: F.element_at("turns", i)["target"] | (i == size))
    exploded = shown.select("conv_id", "turns", F.posexplode(places).alias("example", "n_turns"))
    last = F.element_at("turns", F.col("n_turns"))
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("n_turns") - 1),
                                       lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    parts = exploded.select("conv_id", F.col("example").cast("long").alias("example"),
                            F.col("n_turns").cast("long").alias("n_turns"), context.alias("context"), last.alias("last"))
    return parts.select(
        "conv_id", "example", "n_turns",
        F.concat("context", "last.head", "last.body", F.lit(CLOSE)).alias("formatted"),
        (F.length("context") + F.length("last.head")).cast("long").alias("loss_start"),
        F.when(F.col("last.target"), F.length("last.body")).otherwise(F.lit(0)).cast("long").alias("loss_length"))


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, start + 1, length))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    def turn(part: Column) -> Column:
        # the role holds no line break, so the first one ends the head
        body = F.substring_index(part, "\n", 1)
        return F.struct(F.url_decode(F.substring(body, F.lit(len(OPEN) + 1), F.length(body))).alias("role"),
                        unescape(F.substring(part, F.length(body) + 2, F.length(part))).alias("text"))

    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    return bind(parts, lambda p: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), turn))


def digests(written: DataFrame) -> DataFrame:
    """One row for each conversation from its written examples: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (code points
    of all its examples)."""
    per_conv = written.groupBy("conv_id").agg(
        F.max_by("formatted", "n_turns").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", loss_text(
            F.col("formatted"), F.col("loss_start").cast("int"), F.col("loss_length").cast("int")).alias("text"))))
        .alias("losses"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("losses", lambda x: x["text"]), "")
    turns = per_conv.select("conv_id", parse(F.col("whole")).alias("turns"), loss.alias("loss"), "formatted_chars")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
