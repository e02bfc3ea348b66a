"""Chat formatting: grammar, escapes and whole conversations."""

import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import chat
from starloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
BITS = ["<", "/", "s>", "</s>", "<s>", "\\", "[", "INST]", "[INST]", " [/INST]", "[/INST] ", "<<SYS>>\n", "\n<</SYS>>", "<</SYS>>", "[ROLE] ", "[/ROLE] ", "ROLE]", "SYS>>", " ", "\n", "é", "𝄞", "ok", ""]
TEXT = st.lists(st.sampled_from(BITS), max_size=12).map("".join)
ROLE = st.one_of(st.sampled_from(["system", "user", "assistant", "", "tool"]), TEXT)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5))
def test_every_conversation_is_read_back(turns):
    parts = [chat.render(role, text) for role, text in turns]
    whole = "".join(p for p, _, _ in parts)
    assert chat.parse(whole) == turns
    for (role, text), (part, start, stop) in zip(turns, parts):
        assert chat.unescape(part[start:stop]) == text
    reader = chat._Reader()
    for part, (role, _) in zip(parts, turns):
        reader.feed(part[0], *(part[1:] if role == "assistant" else (None, None)))
    n, turns_sha, loss_chars, loss_sha, chars = reader.done()
    loss = "".join(t for r, t in turns if r == "assistant")
    assert (n, loss_chars, chars) == (len(turns), len(loss), len(whole))
    assert turns_sha == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert loss_sha == hashlib.sha256(loss.encode()).hexdigest()


@given(TEXT)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat.CONTROL.search(chat.escape(text))


def test_only_conflicting_text_is_escaped():
    assert chat.render("user", "a \\ < [b] s>")[0] == "[INST] a \\ < [b] s> [/INST]"
    assert chat.render("assistant", "x</s>")[0] == " x<\\/s></s>"
    assert chat.render("assistant", "x<\\/s>")[0] == " x<\\\\/s></s>"
    assert chat.render("a</s>", "t")[0] == "[ROLE] a<\\/s>[/ROLE] t</s>"


@pytest.mark.parametrize("bad", ["x", "[INST] a", "[INST] a</s>", " a", "[INST] a[/INST]", "<<SYS>>\na<</SYS>>", "[ROLE] a[/ROLE]b</s>", "[ROLE] a [ROLE] b</s>", "</s>", " a</s>["])
def test_what_is_no_conversation(bad):
    with pytest.raises(chat.ParseError):
        chat.parse(bad)


ROWS = [
    (1, 0, "user", "a"), (1, 1, "assistant", "b</s>"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, None, "system", None), (2, 0, None, ""), (2, 0, "", "z"),
    (3, 5, "assistant", None), (None, 0, "user", "n"), (None, 1, "assistant", "[INST]" * 3), (4, 0, "tool", "x" * 3_000_000 + "</s>"), (4, 1, "assistant", "é" * 10),
]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t is not None, t or 0, role is not None, role or "", chat.render(role or "", text or "")[0], text or "") for c, t, role, text in rows if c == conv]
        own.sort()
        turns = "".join(f"{r[3]}\n{r[5]}\n" for r in own)
        loss = "".join(r[5] for r in own if r[3] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(r[4]) for r in own))
    return out


def test_round_trip_equals_brute_force(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "conv_id long, turn long, role string, text string, formatted int, mask_start string").repartition(5)
    got = chat.round_trip(df).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(ROWS) and len(got) == 5
    assert chat.round_trip(df.limit(0)).count() == 0


def test_a_large_conversation_is_spread_until_it_is_read(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-5).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t</s>"), "id").alias("text"))
    plan = chat.format_turns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    rows = {r.conv_id: r for r in chat.round_trip(df).collect()}
    ids = [i for i in range(20_000) if i % 3]
    assert rows[-5].n_turns == len(ids) and len(rows) == 1 + 20_000 - len(ids)
    assert rows[-5].loss_sha256 == hashlib.sha256("".join(f"t</s>{i}" for i in ids if i % 2).encode()).hexdigest()


def test_chat_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.execute(ORACLES["op11_chat"]).fetchall()
    got = QUERIES["op11_chat"](spark, SF).select(*[d[0] for d in con.description]).collect()
    assert sorted(map(tuple, got)) == sorted(want) and min(r.conv_id for r in got) == -1
