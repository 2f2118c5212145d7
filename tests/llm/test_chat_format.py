"""Formatting of conversations: exact round trips, placeholders, masks."""

import hashlib
import itertools

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from skygauge.llm import chat_format, queries

ROWS = f"conv_id long, turn long, role string, parts array<{chat_format.PART}>, piece string, own long, place int"
MARKS = ["[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[END]", "[IMG]", "[AUD]", "[DOC]"]


def text(value):
    return "text", value, None, None, None, None, None


def row(conv_id, turn, role, *parts):
    return conv_id, turn, role, list(parts) if parts != (None,) else None, "x", 1, 2


def back(spark, rows, **options):
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    return chat_format.read_back(chat_format.format_conversations(frame, **options)).collect()


def nasty_texts():
    out = ["", "plain", "é\n東京 𝔘", "\\", "[", "<", "</", "[\\", "s>", "INST]", "\\INST]", "[[INST]]", "<<s>>", "$1\\$2"]
    for mark in MARKS:
        out += [mark, mark[0] + "\\" + mark[1:], mark[0] + "\\\\" + mark[1:], mark * 3, mark[:-1], "a" + mark + "\\" + mark]
    return out


def test_texts_and_roles_come_back(spark):
    texts = nasty_texts()
    roles = ["user", "assistant", "system", "tool", "", None, "User", "[/ROLE]", "a\n[ROLE]b", "assistant "]
    rows, wanted = [], {}
    for k, (role, value) in enumerate(itertools.product(roles, texts)):
        rows += [row(k, 0, role, text(value)), row(k, 1, "assistant", text(value + "!")), row(k, 2, role, text("z" + value))]
        wanted[k] = [(role or "", value), ("assistant", value + "!"), (role or "", "z" + value)]
    got = back(spark, rows)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == wanted
    for r in got:
        assert r.loss_text == "".join(t for role, t in wanted[r.conv_id] if role == "assistant")
        assert [s.start for s in r.spans] == [sum(s.length for s in r.spans[:k]) for k in range(len(r.spans))]
        assert sum(s.length for s in r.spans) == len(r.formatted)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="[]</>s\\INSTROLEDMGAU x", max_size=30), min_size=1, max_size=4), min_size=1, max_size=60))
def test_parts_that_are_neighbours_hold_no_control_string(spark, values):
    rows = [row(k, 0, "assistant", *map(text, some)) for k, some in enumerate(values)]
    got = {r.conv_id: (r.turns[0].text, r.loss_text, len(r.turns)) for r in back(spark, rows)}
    assert got == {k: ("".join(some), "".join(some), 1) for k, some in enumerate(values)}


def test_parts_become_ordered_placeholders(spark):
    parts = [text("see ["), ("image", None, "a.png", 56, 29, None, None), text("INST] and"), text(" then"),
             ("audio", "ignored", "b.wav", None, None, 2.1, None), ("document", None, None, None, None, None, 3),
             ("other", "kept", None, None, None, None, None), None, ("image", None, "c.png", None, None, None, None),
             (None, "bare", None, None, None, None, None)]
    rows = [row(1, 5, "user", *parts), row(1, 7, "assistant", text("ok "), ("image", None, "d", 1, 1, None, None), text("<s>"))]
    got, = back(spark, rows)
    assert got.formatted == ("[INST]see [[IMG]INST] and then[AUD][DOC]kept[IMG]bare[/INST]<s>ok [IMG]<\\s></s>")
    assert got.turns[0].texts == ["see [", "INST] and then", "", "kept", "bare"]
    assert got.turns[0].kinds == ["image", "audio", "document", "image"]
    assert [tuple(a) for a in got.attachments] == [
        (0, "image", "a.png", 0, 4), (0, "audio", "b.wav", 1, 53), (0, "document", None, 2, 1536), (0, "image", "c.png", 3, 1),
        (1, "image", "d", 0, 1)]
    assert got.expanded_tokens == 4 + 53 + 1536 + 1 + 1
    assert got.loss_text == "ok <s>"
    small = back(spark, rows, expansion=chat_format.Expansion(patch=14, audio_per_second=1, document_per_page=2))[0]
    assert [a.tokens for a in small.attachments] == [12, 3, 6, 1, 1]


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [row(1, 2, "user", text("b")), row(1, 2, "user", text("a")), row(1, None, "user", text("first")),
            row(1, 2, "assistant", text("c")), row(1, 2, "user", text("a")), row(2, 0, "user", None), row(2, 1, None, text(None)),
            row(None, 0, "user", text("x")), row(None, 0, "assistant", text("y"))]
    got = back(spark, rows)
    turns = sorted((str(r.conv_id), [(t.role, t.text) for t in r.turns]) for r in got)
    assert turns == [("1", [("user", "first"), ("assistant", "c"), ("user", "a"), ("user", "a"), ("user", "b")]),
                     ("2", [("user", ""), ("", "")]), ("None", [("assistant", "y")]), ("None", [("user", "x")])]
    long = "é" * 200_000 + "[INST]"
    assert back(spark, [row(3, 0, "user", text(long))])[0].turns[0].text == long
    empty = spark.createDataFrame([], ROWS)
    assert chat_format.read_back(chat_format.format_conversations(empty)).collect() == []


def test_query_digests(spark, tmp_path):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "system", None), (1, 1, "user", "q"), (1, 2, "assistant", "<s>a\\"), (1, 3, "assistant", "b"), (2, 0, "tool", said)]
    frame = spark.createDataFrame([(*r, "n") for r in rows], "conv_id long, turn long, role string, text string, parts string")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.QUERIES["op13_chat_format"](spark, str(tmp_path)).collect()}
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert set(got) == {r[0] for r in rows}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for conv_id, r in got.items():
        own = [(role, t or "") for c, _, role, t in rows if c == conv_id]
        loss = "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_conversations_are_shuffled_once(spark):
    frame = spark.createDataFrame([row(1, 0, "user", text("a"))], ROWS)
    plan = chat_format.format_conversations(frame.repartition(2, F.rand()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(conv_id") == 1
    assert "Python" not in plan and "Arrow" not in plan
