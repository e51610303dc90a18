"""Chat formatting: typed content parts become one marked-up text per conversation.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. A visitor goes through a turn's parts in order:
text is escaped, an image, audio or document becomes a placeholder ``<|kind|>`` and any other kind
``<|other|>``, with an entry in ``attachments`` (turn place, part place, kind as given, reference,
expanded tokens). Placeholders are a closed set, so no kind can hold a control string either, and
``read_turns`` gives a turn back as typed parts, in which a text that looks like a placeholder is a
text. Escaping puts one more
backslash into ``<|``, ``<\\|``, ``<\\\\|`` ..., so no text can hold a control string, and
unescaping takes one away. Roles are escaped likewise, and their line ends and percent signs as
``%0A`` and ``%25``. ``loss_spans`` are the code points (start, end) of assistant text.

Cases: a null text, part list, role or part is empty; turns of a conversation are ordered by
turn, role and text, nulls first, so ties and repeated rows have a defined place and all stay;
a null conversation id is a conversation of its own; a part of another kind has no tokens;
neighbouring text parts of a turn are read back as one; an empty table gives no rows. A conversation becomes one row, whatever its length:
that is the result asked for, and its size is limited by what a row holds (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Kinds of parts that have a placeholder of their own.
KINDS, OTHER = ("image", "audio", "document"), "other"
PLACEHOLDER = rf"<\|({'|'.join((*KINDS, OTHER))})\|>"
PART_TYPE = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Expanded tokens: image pixels to a side of a patch, audio frames a second, tokens a page.
PATCH, FRAMES, PAGE = 28, 25, 1024


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def text_parts(text: Column) -> Column:
    """A plain text as the one part of its turn."""
    null = F.lit(None)
    fields = {"kind": F.lit("text"), "text": text, "ref": null, "width": null, "height": null, "seconds": null, "pages": null}
    return F.array(F.struct(*[c.alias(n) for n, c in fields.items()])).cast(PART_TYPE)


def part_tokens(part: Column) -> Column:
    """Tokens that a placeholder stands for."""
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    return (
        F.when(part["kind"] == "image", image)
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE)
        .otherwise(0)
        .cast("long")
    )


def flattened(parts: Column) -> Column:
    """The parts of a turn in order as one text with placeholders."""

    def visit(part):
        kind = F.coalesce(part["kind"], F.lit("text"))
        return F.when(kind == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), F.when(kind.isin(*KINDS), kind).otherwise(OTHER), F.lit("|>")))

    return F.coalesce(F.array_join(F.transform(parts, visit), ""), F.lit(""))


def attachments(parts: Column) -> Column:
    """(part, kind, ref, n_tokens) of the parts that are not text."""
    entries = F.transform(
        F.coalesce(parts, F.array().cast(PART_TYPE)),
        lambda part, i: F.struct(i.alias("part"), part["kind"].alias("kind"), part["ref"].alias("ref"), part_tokens(part).alias("n_tokens")),
    )
    return F.filter(entries, lambda e: F.coalesce(e["kind"], F.lit("text")) != "text")


def formatted_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """conv_id, formatted, loss_spans, attachments, n_attachment_tokens: one row per conversation."""
    said = F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), said.alias("role"),
        flattened(F.col(parts)).alias("body"), attachments(F.col(parts)).alias("files"),
    )
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("piece", F.concat(head, F.col("body"), F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", F.xxhash64("files"))
    rows = rows.withColumn("place", F.row_number().over(order) - 1)
    rows = rows.withColumn("ends", F.sum(F.char_length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.col("ends") - len(END) - 1
    span = F.struct((stop - F.char_length("body")).alias("start"), stop.alias("end"))
    held = F.transform("files", lambda e: F.struct(F.col("place").alias("turn_place"), e["part"].alias("part"), e["kind"].alias("kind"), e["ref"].alias("ref"), e["n_tokens"].alias("n_tokens")))
    entry = F.struct("place", "piece", F.when(F.col("role") == ASSISTANT, span).alias("span"), held.alias("held"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("all"))
    files = F.flatten(F.transform("all", lambda e: e["held"]))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("all", lambda e: e["piece"]), "").alias("formatted"),
        F.filter(F.transform("all", lambda e: e["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda n, e: n + e["n_tokens"]).alias("n_attachment_tokens"),
    )


def read_parts(body: Column) -> Column:
    """The (kind, text) parts of a turn's body; text is null for what is no text."""

    def one(piece):
        kind = F.regexp_extract(piece, f"^{PLACEHOLDER}$", 1)
        return F.struct(F.when(kind == "", "text").otherwise(kind).alias("kind"), F.when(kind == "", unescaped(piece)).alias("text"))

    # Placeholders are the only control strings in a body that are not escaped; it is cut before and behind them.
    pieces = F.split(body, f"(?={PLACEHOLDER})|(?<={PLACEHOLDER})")
    return F.transform(F.filter(pieces, lambda p: p != ""), one)


def read_turns(formatted: Column, typed: bool = True) -> Column:
    """The (role, text, parts) of the turns of a formatted conversation; in ``text`` placeholders stand as they
    are, in ``parts`` (with ``typed``) they are told from texts."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(piece):
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.char_length(role) + 2, F.char_length(piece))
        return F.struct(
            unescaped_role(F.substring(role, F.lit(len(START) + 1), F.char_length(role))).alias("role"),
            unescaped(body).alias("text"),
            *([read_parts(body).alias("parts")] if typed else []),
        )

    return F.transform(pieces, one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one span after the other."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digests(chats: DataFrame) -> DataFrame:
    """What is read back from formatted conversations."""
    read = chats.select("*", F.inline(F.array(F.struct(read_turns(F.col("formatted"), typed=False).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "n_attachment_tokens",
    )
