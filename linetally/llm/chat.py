"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; each is
zipped with the one before it, adjacent turns of one role are merged into
one block, and arrays of pieces are joined into the formatted text::

    <turn>user<turn-text>first text<turn-also>next text of this role</turn>
    <turn>assistant<turn-text>answer</turn>

Every marker begins with ``<turn`` or ``</turn``. In texts and roles a backslash
is put behind the ``<`` of whatever looks like that, also if it has backslashes there
already (``</turn>`` becomes ``<\\/turn>``, that ``<\\\\/turn>``). So no text holds a
marker, other texts stay as they are, and taking one backslash away gives each text
back (:func:`read_turns`).

``segments`` are the pieces in order, each with its flag ``loss``: the texts of
roles to learn are under the loss mask, markers never are. ``formatted`` is the pieces joined;
:func:`loss_spans` gives the masked stretches of it by code point.

All steps are linear in the conversation's length but for :func:`loss_spans`,
which adds to an array turn by turn. A conversation is one cell of the result, so it
must fit into one (2 GB); the rows are shuffled once, by conversation.

Results for odd input: null texts and roles are read as empty; turns come in the order of
(turn, role, text), null turns first, so ties have one order and repeated rows
are repeated turns; rows without a conversation id are one conversation, whose id is null; other
columns are left out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BODY, ALSO, CLOSE = "<turn>", "<turn-text>", "<turn-also>", "</turn>\n"
LOSS_ROLES = ("assistant",)

_SEGMENT = "struct<text:string,loss:boolean>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*/?turn)", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*/?turn)", r"<$1")


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """One row per conversation: the id (column ``conv``), ``formatted`` and ``segments``
    (array of ``text``, ``loss``), whose texts joined are ``formatted``."""
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    row = F.struct(F.col(f"`{turn}`").alias("turn"), plain(role).alias("role"), plain(text).alias("text"))
    sorted_turns = turns.groupBy(F.col(f"`{conv}`").alias("_conv")).agg(F.sort_array(F.collect_list(row)).alias("_turns"))
    # each turn meets the role before it; a null stands before the first
    first = F.array(F.lit(None).cast("string"))
    before = F.concat(first, F.transform(F.slice("_turns", 1, F.size("_turns") - 1), lambda t: t["role"]))

    def pieces(t: Column, previous: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape(t["role"]), F.lit(BODY))
        lead = (F.when(previous == t["role"], F.lit(ALSO)).when(previous.isNull(), head)
                .otherwise(F.concat(F.lit(CLOSE), head)))
        return F.array(F.struct(lead.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), t["role"].isin(*loss_roles).alias("loss")))

    end = F.array(F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")))
    merged = sorted_turns.select(
        "_conv", F.concat(F.flatten(F.zip_with("_turns", before, pieces)), end).cast(f"array<{_SEGMENT}>").alias("segments"))
    return merged.select(F.col("_conv").alias(conv), F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                         "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (array of ``role``, ``text``) of a formatted text, merged ones apart again."""
    blocks = F.filter(F.split(formatted, CLOSE, -1), lambda b: b != "")
    halves = F.transform(blocks, lambda b: F.split(F.substring(b, len(OPEN) + 1, 2**31 - 1), BODY, 2))
    parts = F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), F.split(h[1], ALSO, -1).alias("texts")))
    return F.flatten(F.transform(parts, lambda p: F.transform(
        p["texts"], lambda t: F.struct(p["role"].alias("role"), unescape(t).alias("text")))))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def loss_spans(segments: Column) -> Column:
    """Stretches of ``formatted`` under the mask: array of ``start``, ``end`` (code points, end exclusive)."""
    span = "array<struct<start:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        after = acc["at"] + F.char_length(s["text"])
        one = F.array(F.struct(acc["at"].alias("start"), after.alias("end")))
        return F.struct(after.alias("at"), F.when(s["loss"], F.concat(acc["spans"], one)).otherwise(acc["spans"]).cast(span).alias("spans"))

    return F.aggregate(segments, start, step, lambda acc: acc["spans"])


def digests(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Of the result of :func:`format_conversations`, read back from it: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and ``formatted_chars``."""
    read = chats.select(F.col(f"`{conv}`").alias("_conv"), "formatted", read_turns(F.col("formatted")).alias("_turns"),
                        loss_text(F.col("segments")).alias("_loss"))
    lines = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        F.col("_conv").alias(conv), F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
