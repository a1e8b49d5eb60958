r"""Conversations as one training text each: typed content parts, turn marks, loss mask, and the way back.

A turn's content is a list of typed parts (text, image, audio, document). A visitor flattens it: text is escaped, every
other part becomes a placeholder, and its reference and expanded token count are recorded; the k-th placeholder of a
conversation's text belongs to its k-th attachment. Turns get the marks of their role and are joined in order.

Control strings inside texts and role names get a backslash behind their first character, backslashes are doubled, so
no text can look like a mark and `read_back` returns every role and text exactly. The loss mask holds one span for each
assistant turn, in code points of that turn's marked text; placeholders inside a span bear no loss.

DataFrame functions only. Texts are escaped before they are shuffled once, by conversation. One conversation is one
row, as its text and the digests of it are one value each: a conversation must fit into a string (2 GB) and one task.

Nulls: a null text, part or content is empty, a null role is the empty role, null conversation ids are one
conversation, null turns come last. Turns with one number stand in the order of role and text; repeated rows are turns
of their own. Unknown kinds of parts are files with no tokens. No rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Marks of the template. An assistant's turn has no mark in front, as it follows another turn's.
BEGIN = "<s>"
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("", "</s>")}
ROLE_OPEN, ROLE_CLOSE, TURN_CLOSE = "[ROLE]", "[/ROLE]", "[/TURN]"
PLACEHOLDERS = {"image": "[IMAGE]", "audio": "[AUDIO]", "document": "[DOCUMENT]"}
OTHER = "[FILE]"

#: First characters of control strings, by what follows them.
CONTROL = r"<(?=/?s>|</?SYS>>)|\[(?=/?(?:INST|ROLE|TURN|IMAGE|AUDIO|DOCUMENT|FILE)\])"
PLACEHOLDER = r"\[(?:IMAGE|AUDIO|DOCUMENT|FILE)\]"
TURN = (r"(?s)\[INST\].*?\[/INST\]|<<SYS>>.*?<</SYS>>|\[ROLE\].*?\[/ROLE\].*?\[/TURN\]|.*?</s>")

PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")


@dataclass(frozen=True)
class Rates:
    """Tokens that a placeholder stands for: one per square of pixels, per part of a second, and so many a page; and
    of a part whose size is not known."""

    pixels: int = 28
    a_second: float = 25.0
    a_page: int = 512
    unknown: int = 256


def text_part(text: Column) -> Column:
    """Content of one text part."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in
               (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), *nothing))


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def visit(part: Column) -> Column:
    """What a part is in the text."""
    kind = F.coalesce(part["kind"], F.lit("text"))
    shown = F.when(kind == "text", escaped(part["text"]))
    for name, placeholder in PLACEHOLDERS.items():
        shown = shown.when(kind == name, placeholder)
    return F.when(part.isNull(), "").otherwise(shown.otherwise(OTHER))


def expanded(part: Column, rates: Rates) -> Column:
    """Tokens that a part's placeholder stands for."""
    squares = F.ceil(part["width"] / rates.pixels) * F.ceil(part["height"] / rates.pixels)
    counts = {"image": squares, "audio": F.ceil(part["seconds"] * rates.a_second), "document": part["pages"] * rates.a_page}
    tokens = None
    for kind, count in counts.items():
        known = F.coalesce(F.when(count > 0, count), F.lit(rates.unknown))
        tokens = F.when(part["kind"] == kind, known) if tokens is None else tokens.when(part["kind"] == kind, known)
    return tokens.otherwise(0).cast("long")


def attachment(part: Column, rates: Rates) -> Column:
    return F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), expanded(part, rates).alias("tokens"))


def marks_of(role: Column) -> tuple[Column, Column]:
    """What stands in front of a turn's text and behind it."""
    front = back = None
    for name, (start, end) in MARKS.items():
        front = F.when(role == name, start) if front is None else front.when(role == name, start)
        back = F.when(role == name, end) if back is None else back.when(role == name, end)
    return front.otherwise(F.concat(F.lit(ROLE_OPEN), escaped(role), F.lit(ROLE_CLOSE))), back.otherwise(TURN_CLOSE)


def format_conversations(rows: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """conv_id, formatted, loss_spans (turn from 0, start, end), attachments (turn, kind, ref, tokens) and
    expanded_tokens of rows of conv_id, turn, role and content (an array of PART)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    content = F.coalesce(F.col("content"), F.array().cast(f"array<{PART}>"))
    front, back = marks_of(role)
    turns = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), front.alias("front"), back.alias("back"),
        F.array_join(F.transform(content, visit), "").alias("body"),
        F.transform(F.filter(content, lambda p: p["kind"] != "text"), lambda p: attachment(p, rates)).alias("attached"),
    )
    marked = turns.select("conv_id", F.struct(
        F.col("turn").isNull().alias("unplaced"), "turn", "role",
        F.concat("front", "body", "back").alias("text"),
        F.when(F.col("role") == "assistant", F.char_length("front")).alias("start"),
        F.when(F.col("role") == "assistant", F.char_length("front") + F.char_length("body")).alias("end"),
        "attached").alias("t"))
    joined = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    spans = F.transform("turns", lambda t, i: F.struct(i.alias("turn"), t["start"].alias("start"), t["end"].alias("end")))
    attached = F.flatten(F.transform("turns", lambda t, i: F.transform(t["attached"], lambda a: F.struct(
        i.alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return joined.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: t["text"]), "")).alias("formatted"),
        F.filter(spans, lambda s: s["start"].isNotNull()).alias("loss_spans"),
        attached.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def _between(text: Column, front: int | Column, back: int) -> Column:
    size = F.char_length(text) - front - back
    return F.substring(text, F.lit(front) + 1 if isinstance(front, int) else front + 1, size)


def plain(body: Column) -> Column:
    """The text of a turn's body, without placeholders."""
    return unescaped(F.regexp_replace(body, PLACEHOLDER, ""))


def parsed(turn: Column) -> Column:
    """Role and text of one turn as it stands in a formatted text."""
    named = F.regexp_extract(turn, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1)
    out = None
    for name, (start, end) in MARKS.items():
        if start:
            found = F.struct(F.lit(name).alias("role"), plain(_between(turn, len(start), len(end))).alias("text"))
            out = F.when(turn.startswith(start), found) if out is None else out.when(turn.startswith(start), found)
    other = F.char_length(named) + len(ROLE_OPEN) + len(ROLE_CLOSE)
    out = out.when(turn.startswith(ROLE_OPEN), F.struct(
        unescaped(named).alias("role"), plain(_between(turn, other, len(TURN_CLOSE))).alias("text")))
    end = MARKS["assistant"][1]
    return out.otherwise(F.struct(F.lit("assistant").alias("role"), plain(_between(turn, 0, len(end))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds, from the formatted text and its mask alone, `turns` (role and text of each) and `loss_texts` (what the
    spans hold), unescaped."""
    cut = formatted.withColumn("_turns", F.regexp_extract_all(
        F.substring("formatted", F.lit(len(BEGIN) + 1), F.char_length("formatted")), F.lit(TURN), 0))
    return cut.withColumns({
        "turns": F.transform("_turns", parsed),
        "loss_texts": F.transform("loss_spans", lambda s: plain(F.substring(
            F.get(F.col("_turns"), s["turn"]), s["start"] + 1, s["end"] - s["start"]))),
    }).drop("_turns")


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation: its turns and its loss as read back, as counts and digests."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = read_back(formatted).withColumn("_loss", F.array_join("loss_texts", ""))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens",
    )
