"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an ordered list of parts (``PART``): text, image, audio
or document. A visitor flattens each part: a text part gives its escaped
text, any other part an ordered placeholder ``<kind:turn.part>`` (both
counted from 0 within the conversation and the turn), an attachment record
(turn, part, kind, ref) and the number of tokens the placeholder expands to.

Template of one turn::

    <turn ROLE>\\n CONTENT </turn>\\n        (no spaces around the content)

Control strings all start with ``<``. Inside texts and roles ``\\`` is
written ``\\s``, ``<`` is written ``\\l`` and ``>`` is written ``\\g``, so no text
can hold a control string and the escape is undone exactly.

The formatted conversation is the concatenation of ``segments`` in order.
Segments flagged ``loss`` are the loss mask: the content of the turns of the
trained role and nothing between.

Defined results: rows of a conversation are ordered by turn, ties by role,
then content; repeated rows are repeated turns. A null role or text is empty,
a null list of parts or a null part gives nothing. An unknown kind is a
placeholder of 0 tokens. A null conversation id is a conversation of its own.
Unknown sizes of an attachment count as the least size (1 tile, 1 frame,
1 page). An empty table gives an empty result; only the named columns are
read, so extra columns do no harm. A conversation becomes one row, as its
format is one string.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Expansion:
    """Tokens that an attachment's placeholder stands for."""

    image_tile: int = 28  # pixels: one token for each tile
    audio_per_second: float = 25.0
    document_per_page: int = 1024


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\s"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A list with one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"))).cast(
        "array<struct<kind:string,text:string>>"
    )


def typed(parts: Column) -> Column:
    """Text-only part lists (kind, text) with the other fields of ``PART`` as nulls."""
    null = F.lit(None)
    return F.transform(
        parts,
        lambda p: F.struct(
            p["kind"].alias("kind"),
            p["text"].alias("text"),
            null.cast("string").alias("ref"),
            null.cast("int").alias("width"),
            null.cast("int").alias("height"),
            null.cast("double").alias("seconds"),
            null.cast("int").alias("pages"),
        ),
    )


def _tokens(part: Column, size: Expansion) -> Column:
    def steps(length: Column) -> Column:
        return F.greatest(F.ceil(F.coalesce(length, F.lit(1)) / F.lit(size.image_tile)), F.lit(1))

    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(size.audio_per_second))
    return (
        F.when(part["kind"] == "image", steps(part["width"]) * steps(part["height"]))
        .when(part["kind"] == "audio", F.greatest(audio, F.lit(1)))
        .when(part["kind"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * size.document_per_page)
        .otherwise(0)
        .cast("long")
    )


def _visited(parts: Column, ordinal: Column, size: Expansion) -> Column:
    """One struct for each part: its content and, unless it is text, its attachment record."""

    def visit(part: Column, i: Column) -> Column:
        kind = F.coalesce(part["kind"], F.lit("part"))
        is_text = kind == "text"
        mark = F.concat(F.lit("<"), escape(kind), F.lit(":"), ordinal.cast("string"), F.lit("."), i.cast("string"), F.lit(">"))
        record = F.struct(
            ordinal.cast("int").alias("turn"),
            i.cast("int").alias("part"),
            kind.alias("kind"),
            part["ref"].alias("ref"),
            _tokens(part, size).alias("tokens"),
        )
        return F.struct(
            F.when(is_text, escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark).alias("content"),
            F.when(~is_text, record).alias("attachment"),
        )

    return F.filter(F.transform(parts, lambda p, i: F.when(p.isNotNull(), visit(p, i))), lambda v: v.isNotNull())


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    trained: str = "assistant",
    size: Expansion = Expansion(),
) -> DataFrame:
    """One row for each conversation: conv_id, n_turns, formatted, segments, attachments, attachment_tokens."""
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")).alias("parts"),
        ).alias("row"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    visited = chats.select(
        "conv_id",
        F.transform(
            "rows", lambda r, i: F.struct(r["role"].alias("role"), _visited(r["parts"], i, size).alias("parts"))
        ).alias("turns"),
    )
    cut = visited.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(
            F.transform(
                "turns",
                lambda t: F.array(
                    _segment(F.concat(F.lit("<turn "), escape(t["role"]), F.lit(">\n")), F.lit(False)),
                    _segment(F.array_join(t["parts"]["content"], ""), t["role"] == trained),
                    _segment(F.lit("</turn>\n"), F.lit(False)),
                ),
            )
        ).alias("segments"),
        F.filter(F.flatten(F.transform("turns", lambda t: t["parts"]["attachment"])), lambda a: a.isNotNull()).alias(
            "attachments"
        ),
    )
    return cut.select(
        "conv_id",
        "n_turns",
        F.array_join(F.col("segments")["text"], "").alias("formatted"),
        "segments",
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
    )


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped; placeholders stay as they are."""
    marked = F.filter(F.split(formatted, "</turn>\n"), lambda piece: piece != "")

    def parse(piece: Column) -> Column:
        head = F.substring_index(piece, ">\n", 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len("<turn ") + 1))).alias("role"),
            unescape(F.substr(piece, F.char_length(head) + F.lit(len(">\n") + 1))).alias("text"),
        )

    return F.transform(marked, parse)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
