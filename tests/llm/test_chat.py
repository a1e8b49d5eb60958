"""Formatted conversations: marks, escapes, placeholders, mask, and the way back."""

import hashlib

import pytest
from pyspark.sql import functions as F

from claimwright.llm import chat

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]", "[IMAGE]", "[FILE]",
           "[AUDIO]", "[DOCUMENT]", "\\", "\\\\", "<", "[", "</", "<\\/s>", "[\\INST]"]

ROWS = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"),
    (2, 0, "system", "be brief <</SYS>> <"), (2, 2, "assistant", "é😀 日本\x00\n"), (2, 1, "user", None),
    (3, 0, "assistant", ""), (3, 0, "assistant", "b"), (3, 0, "assistant", "a"),
    (4, 0, "to[/ROLE]ol\\", "x[/TURN]"), (4, 1, None, None), (4, None, "user", "last"),
    (None, 0, "user", "nobody"), (None, 1, "assistant", "said this"),
    (5, 0, "assistant", "same"), (5, 0, "assistant", "same"),
    (6, 0, "user", " ".join(CONTROL)), (6, 1, "assistant", "".join(CONTROL)), (6, 2, "assistant", "".join(CONTROL[::-1])),
    (7, 0, "user", "word <s> \\ " * 40_000), (7, 1, "assistant", "[/INST]" * 30_000),
    (8, 0, "assistant", "<<s>"), (8, 1, "Assistant", "[[/ROLE]"), (8, 2, "", "no role"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        out[conv] = (len(own), digest("".join(f"{role}\n{text}\n" for _, _, role, text in own)), len(loss), digest(loss))
    return out


def content(frame):
    return frame.withColumn("content", chat.text_part(F.col("text")))


def test_read_back_equals_the_table(spark):
    rows = content(spark.createDataFrame(ROWS, SCHEMA).repartition(3)).withColumns(
        {"formatted": F.lit("clash"), "turns": F.lit(1), "body": F.lit("clash")})
    got = chat.digests(chat.format_conversations(rows)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == brute(ROWS)


def test_marks_and_mask(spark):
    out = chat.format_conversations(content(spark.createDataFrame(ROWS[:2], SCHEMA))).first()
    assert out["formatted"] == r"<s>[INST]<\/s>[\INST] ok [\/INST][/INST]<\/s>[\INST] ok [\/INST]</s>"
    assert [tuple(s) for s in out["loss_spans"]] == [(1, 0, 24)]
    assert out["attachments"] == [] and out["expanded_tokens"] == 0


def test_typed_parts(spark):
    """Placeholders stand in order of the parts, with their references and tokens; text comes back without them."""
    schema = f"conv_id long, turn long, role string, content array<{chat.PART}>"
    none = (None,) * 4
    rows = [
        (1, 1, "assistant", [("text", "a [IMAGE]", None, *none), ("document", None, "d.pdf", None, None, None, 3),
                             ("text", " b", None, *none)]),
        (1, 0, "user", [("image", None, "i.png", 57, 28, None, None), ("text", "look", None, *none),
                        ("audio", "ignored", "s.wav", None, None, 1.5, None), None, ("image", None, None, *none),
                        ("video", None, "v.mp4", *none)]),
        (1, 2, "user", None), (1, 3, "user", []),
        (2, 0, "user", [(None, "untyped", None, *none), ("image", None, "bad", -5, 28, None, None)]),
    ]
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    one = out[1]
    assert one["formatted"] == (r"<s>[INST][IMAGE]look[AUDIO][IMAGE][FILE][/INST]a [\IMAGE][DOCUMENT] b</s>"
                                "[INST][/INST][INST][/INST]")
    assert [tuple(a) for a in one["attachments"]] == [
        (0, "image", "i.png", 3), (0, "audio", "s.wav", 38), (0, "image", None, 256), (0, "video", "v.mp4", 0),
        (1, "document", "d.pdf", 1536)]
    assert one["expanded_tokens"] == 3 + 38 + 256 + 1536
    assert [tuple(t) for t in one["turns"]] == [("user", "look"), ("assistant", "a [IMAGE] b"), ("user", ""), ("user", "")]
    assert one["loss_texts"] == ["a [IMAGE] b"]
    assert [tuple(t) for t in out[2]["turns"]] == [("user", "untyped")]
    assert [tuple(a) for a in out[2]["attachments"]] == [(0, "image", "bad", 256)]


def test_rates(spark):
    schema = f"conv_id long, turn long, role string, content array<{chat.PART}>"
    rows = [(1, 0, "user", [("image", None, "i", 100, 100, None, None), ("audio", None, "a", None, None, None, None)])]
    out = chat.format_conversations(spark.createDataFrame(rows, schema), chat.Rates(pixels=50, unknown=7)).first()
    assert [a["tokens"] for a in out["attachments"]] == [4, 7]


def test_no_rows(spark):
    assert chat.digests(chat.format_conversations(content(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_plan_has_no_python(spark):
    frame = chat.digests(chat.format_conversations(content(spark.createDataFrame(ROWS[:2], SCHEMA))))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2


@pytest.mark.parametrize("text", CONTROL + ["\\<s>", "<\\s>", "[[INST]]", "<<<SYS>>>", "a\\"])
def test_escape_is_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escaped(F.col("t")).alias("e")).select(
        "e", chat.unescaped(F.col("e")).alias("u")).first()
    assert row["u"] == text
    assert not any(c in row["e"] for c in CONTROL[:13])
