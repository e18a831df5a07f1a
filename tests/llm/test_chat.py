"""Chat formatting: whatever a text holds, the conversation comes back."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa

from tripkit.llm import chat

PARTS = ["\\", "<", "|", ">", "<|im_start|>", "<|im_end|>", "\n", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "é", "日本", " ", "a", "im_end", "\\\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(PARTS), max_size=4), st.lists(st.sampled_from(PARTS), max_size=8), st.booleans()), min_size=1, max_size=5),
       st.integers(1, 3))
def test_round_trip(turns, per_conversation):
    rows = [("assistant" if own else "".join(r), "".join(t)) for r, t, own in turns]
    number = [k // per_conversation for k in range(len(rows))]
    table = pa.table({"_id": number, "role": pa.array([r for r, _ in rows], pa.string()), "text": pa.array([t for _, t in rows], pa.string()), "number": number})
    got = chat.assembled(table).to_pylist()
    for k, found in enumerate(got):
        own = [r for r, n in zip(rows, number, strict=True) if n == k]
        text = found["formatted"]
        assert chat.parsed(text) == own
        loss = [chat.unescaped(text[s:e]) for s, e in zip(found["loss_starts"], found["loss_ends"], strict=True)]
        assert loss == [t for r, t in own if r == "assistant"]
        body = "".join(t for p in text.split("<|im_start|>")[1:] for t in p.split("<|im_end|>\n")[:1])
        assert not any(c in body for c in ("<|im", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>"))


def test_edge_rows(spark, monkeypatch):
    rows = [(1, 2, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "system", None), (2, 1, "assistant", None), (None, 1, None, "q"),
            (None, 2, "assistant", "r"), (3, 1, "assistant", "x" * 300_000), *((4, k, "assistant", f"t{k}") for k in range(3000))]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS number", "'f' AS formatted").repartition(4)
    got = {r.conv_id: r for r in chat.format_conversations(turns).collect()}
    for key in (1, 2, 3, 4, None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0))
        assert chat.parsed(got[key].formatted) == [(r[2] or "", r[3] or "") for r in own]
        assert "".join(got[key].formatted[s:e] for s, e in zip(got[key].loss_starts, got[key].loss_ends, strict=True)) == "".join(
            r[3] or "" for r in own if r[2] == "assistant")
    assert len(got) == 5
    read = {r.conv_id: r for r in chat.digests(chat.format_conversations(turns)).collect()}
    assert (read[4].n_turns, read[4].loss_chars, read[2].loss_chars) == (3000, sum(len(f"t{k}") for k in range(3000)), 0)
    assert chat.format_conversations(turns.limit(0)).collect() == []
