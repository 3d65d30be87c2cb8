"""Chat formatting: exact round trip, merging, escapes and the loss mask, against plain Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from linetally.llm import chat, queries

HARD = [r"\### Assistant: </turn> ok", "<turn>", "</turn>\n", r"<\turn>", r"<\\/turn-text>", "<<turn", "<", "a<", "", None, "<turn-also>x</turn>",
        "é🙂\n\n</tur", "\\", "n>", "turn>", "$1 \\1", "</turn>\n<turn>user<turn-text>hi"]


def _escape(t):
    return re.sub(r"<(\\*/?turn)", lambda m: "<\\" + m.group(1), t)


def _plain(rows):
    """(role, text) of each turn, and the formatted text, of one conversation."""
    turns = sorted(((t is not None, t or 0), r or "", x or "") for t, r, x in rows)
    out, spans, before = "", [], None
    for _, role, text in turns:
        out += "<turn-also>" if role == before else (("</turn>\n" if before is not None else "") + f"<turn>{_escape(role)}<turn-text>")
        if role == "assistant":
            spans.append((len(out), len(out) + len(_escape(text))))
        out += _escape(text)
        before = role
    return [(r, x) for _, r, x in turns], out + "</turn>\n", spans


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, segments int")
    chats = chat.format_conversations(df)
    full = chats.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("spans", chat.loss_spans(F.col("segments")))
    got = {r["conv_id"]: r for r in full.collect()}
    digest = {r["conv_id"]: r for r in chat.digests(chats).collect()}
    assert set(got) == {r[0] for r in rows} == set(digest)
    for c in got:
        turns, text, spans = _plain([r[1:] for r in rows if r[0] == c])
        assert got[c]["formatted"] == text and "".join(s["text"] for s in got[c]["segments"]) == text
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert [tuple(s) for s in got[c]["spans"]] == spans
        loss = "".join(x for r, x in turns if r == "assistant")
        d = digest[c]
        assert (d["n_turns"], d["turns_sha256"]) == (len(turns), _sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (d["loss_chars"], d["loss_sha256"], d["formatted_chars"]) == (len(loss), _sha(loss), len(text))


def test_hard_texts_and_odd_rows(spark):
    rows = [(i, j, "assistant" if (i + j) % 3 else "user", t) for i in range(3) for j, t in enumerate(HARD)]
    rows += [(10, 1, None, "a"), (10, 1, "", "b"), (10, None, "user", "c"), (10, 2, "user", "same"), (10, 2, "user", "same"), (None, 1, "user", "x"),
             (None, 2, "assistant", None), (11, 1, "<turn-text>\nodd </turn>\n role", "y"), (12, 1, "assistant", "<turn" * 40_000)]
    _check(spark, rows)


def test_random_strings_come_back(spark):
    r = random.Random(11)
    pieces = ["<", "\\", "/", "turn", ">", "-text", "-also", "\n", "a", "é", "$1"]
    rows = [(i % 60, i, r.choice(["user", "assistant", "system"]), "".join(r.choice(pieces) for _ in range(r.randrange(14)))) for i in range(1500)]
    _check(spark, rows)


def test_a_long_conversation_and_nothing(spark):
    rows = [(1, i, "assistant" if i % 5 else "user", f"t{i} <turn>") for i in range(6000)] + [(2, 0, "user", "x")]
    _check(spark, rows)
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_the_query_adds_the_hard_conversation(spark):
    r = queries.op11_chat(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (2, 26, _sha(HARD[0]))
