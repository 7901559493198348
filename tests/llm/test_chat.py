from __future__ import annotations

import hashlib
from collections import defaultdict

from helpers import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import chat, queries


def expected(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        digest = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(digest.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS formatted", "1 AS t", "2 AS turns", "3 AS p0")
    return chat.format_conversations(df)


def check(spark, rows):
    out = run(spark, rows)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(out).collect()}
    assert got == expected(rows)
    return {r.conv_id: r for r in out.collect()}


HARD = ["</s>", "<s>", "[INST]", "[/INST]", "<\\/s>", "\\", "<", "/s>", "] ", "]", "\\c", "\\l", "é", " ", "\n", "<s>[user] "]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(HARD), max_size=6).map("".join), st.lists(st.sampled_from(HARD), max_size=5).map("".join)), min_size=40, max_size=60))
def test_hostile_turns_come_back(spark, parts):
    rows = [(i // 3, i % 3, "assistant" if i % 2 else role, text) for i, (text, role) in enumerate(parts)]
    assert all(r.round_trip for r in check(spark, rows).values())


def test_levels_and_edges(spark):
    rows = [(1, 0, "user", "plain [INST] x"), (1, 1, "assistant", "fine"), (2, 0, "user", "a</s>b"), (2, 1, "assistant", "c"), (None, 0, "user", None), (3, None, None, "q"), (3, 1, "assistant", ""), (3, 1, "assistant", ""), (4, 0, "assistant", "long " * 100_000)]
    got = check(spark, rows)
    assert got[1].level == 0 and got[1].formatted == "<s>[user] plain [INST] x</s><s>[assistant] fine</s>"
    assert got[2].level == 1 and got[2].formatted == "<s>[user] a<\\/s>b</s><s>[assistant] c</s>"
    s = got[1].loss_spans[0]
    assert got[1].formatted[s.start : s.start + s.length] == "fine"
    assert run(spark, rows).limit(0).count() == 0 and chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_query_adds_the_hostile_conversation(spark):
    r = queries.op7_chat_round_trip(spark, SF).where("conv_id = -7").first()
    x = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(x), hashlib.sha256(x.encode()).hexdigest())
    assert r.turns_sha256 == hashlib.sha256(f"user\n{x}\nassistant\n{x}\n".encode()).hexdigest()
