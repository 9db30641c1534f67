"""Chat formatting: turns of typed content parts become one marked text per conversation.

A visitor turns every part into text: text parts are escaped, image, audio and document parts become
placeholders in order, with their reference and the number of tokens they will expand to. All marks begin
with `<`, and texts hold no `<` after escaping, so the format can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROLE, BODY, END = "<|role|>", "<|text|>", "<|end|>"
#: what begins a control string here or in common other formats, and its escape; the escape sign comes first
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
#: tokens: an image by patches of 28 x 28 pixels, audio by the second, a document by the page
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _text(part: Column) -> tuple[Column, Column]:
    return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0)


def _image(part: Column) -> tuple[Column, Column]:
    patches = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    return F.lit("<|image|>"), patches


def _audio(part: Column) -> tuple[Column, Column]:
    return F.lit("<|audio|>"), F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * PER_SECOND)


def _document(part: Column) -> tuple[Column, Column]:
    return F.lit("<|document|>"), F.coalesce(part["pages"], F.lit(0)) * PER_PAGE


VISITOR = {"image": _image, "audio": _audio, "document": _document}


def visit(part: Column) -> Column:
    """struct(rendered, type, ref, n_tokens) of a part; an unknown or missing type counts as text."""
    rendered, tokens = _text(part)
    for kind, method in VISITOR.items():
        shown, n = method(part)
        rendered = F.when(part["type"] == kind, shown).otherwise(rendered)
        tokens = F.when(part["type"] == kind, n.cast("long")).otherwise(tokens.cast("long"))
    attached = part["type"].isin(*VISITOR)
    return F.struct(
        rendered.alias("rendered"), F.when(attached, part["type"]).alias("type"), part["ref"].alias("ref"), tokens.alias("n_tokens")
    )


def text_part(text: Column) -> Column:
    """A message of one text part."""
    empty = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"), empty("string").alias("ref"), empty("int").alias("width"),
        empty("int").alias("height"), empty("double").alias("seconds"), empty("int").alias("pages"),
    ))


def format_conversations(messages: DataFrame, learnt_role: str = "assistant") -> DataFrame:
    """One row per conversation from (conv_id, turn, role, parts): conv_id, formatted, turns, attachments,
    n_attachment_tokens.

    ``parts`` is an array of PART; null or empty is an empty message. ``turns`` has, in order, where each turn
    begins in ``formatted``, where its body begins and ends (in code points), and whether it is under the loss
    mask, which holds the bodies of ``learnt_role``. ``attachments`` lists the placeholders in order.
    Turns go by number, nulls first; turns of equal number by role and body; equal rows are turns of their own.
    A null role is empty; a null conv_id is a conversation. An empty table gives no rows; other columns are ignored.

    A conversation is one value of the result, so its size is bounded by that of a conversation, nothing more.
    """
    seen = F.transform(F.coalesce("parts", F.array().cast(f"array<{PART}>")), visit)
    turns = (
        messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), seen.alias("seen"))
        .withColumn("body", F.array_join(F.transform("seen", lambda p: p["rendered"]), ""))
        .withColumn("head", F.concat(F.lit(ROLE), escape(F.col("role")), F.lit(BODY)))
        .withColumn("shown", F.concat("head", "body", F.lit(END)))
        .withColumn("size", F.char_length("shown").cast("long"))
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "body")
    placed = turns.withColumn("begin", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    body = F.col("begin") + F.char_length("head")
    row = F.struct(
        "begin", body.alias("body_begin"), (body + F.char_length("body")).alias("body_end"),
        (F.col("role") == learnt_role).alias("loss"), "shown",
        F.filter("seen", lambda p: p["type"].isNotNull()).alias("attached"),
    )
    rows = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    attached = F.flatten(F.transform("rows", lambda r, i: F.transform(r["attached"], lambda p: F.struct(
        i.alias("turn_index"), p["type"].alias("type"), p["ref"].alias("ref"), p["n_tokens"].alias("n_tokens")))))
    return rows.select(
        "conv_id", F.array_join(F.transform("rows", lambda r: r["shown"]), "").alias("formatted"),
        F.transform("rows", lambda r: F.struct(r["begin"].alias("begin"), r["body_begin"].alias("body_begin"),
                                                r["body_end"].alias("body_end"), r["loss"].alias("loss"))).alias("turns"),
        attached.alias("attachments"),
    ).withColumn("n_attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, messages (role and text of every turn) and learnt (the texts under the loss mask), taken from
    ``formatted`` and ``turns`` alone. Placeholders stay in the texts as they are."""
    shown = F.filter(F.split("formatted", F.lit(END.replace("|", "\\|"))), lambda t: t != "")
    cut = formatted.select("conv_id", "formatted", "turns", shown.alias("shown"))
    message = lambda t: F.struct(
        unescape(F.substring_index(F.substring(t, len(ROLE) + 1, 1 << 30), BODY, 1)).alias("role"),
        unescape(F.substring_index(t, BODY, -1)).alias("text"),
    )
    masked = F.zip_with("shown", "turns", lambda t, m: F.when(m["loss"], unescape(F.substr(
        t, (m["body_begin"] - m["begin"] + 1).cast("int"), (m["body_end"] - m["body_begin"]).cast("int")))))
    return cut.select(
        "conv_id", "formatted", F.transform("shown", message).alias("messages"),
        F.filter(masked, lambda t: t.isNotNull()).alias("learnt"),
    )
