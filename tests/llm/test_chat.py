import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveline.llm import chat
from sieveline.llm.queries import vocabulary

PARTS = st.lists(st.sampled_from(["<|turn|>", "<|over|>", "\n", "\\", "<", "|", ">", " ", "n", "é", "😀", "assistant", "hello", "\r", "\x00"]), max_size=12)
TURNS = st.lists(st.tuples(PARTS.map("".join), PARTS.map("".join)), max_size=5)


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_round_trip(turns):
    text, spans = chat.render(turns)
    assert chat.parsed(text) == turns
    assert [chat.unescaped(text[start:end]) for start, end in spans] == [body for _, body in turns]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), max_size=8))
def test_overlaps(lengths, gaps):
    ends = np.cumsum([0, *lengths])
    offsets = list(zip(ends, ends[1:]))
    spans, at = [], 0
    for gap, length in gaps:
        spans.append((at + gap, at + gap + length))
        at += gap + length
    token, starts, stops = chat.overlaps(offsets, spans)
    found = {(int(t), int(a), int(b)) for t, a, b in zip(token, starts, stops) if a < b}
    assert found == {(t, max(a, c), min(b, d)) for t, (a, b) in enumerate(offsets) for c, d in spans if max(a, c) < min(b, d)}


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expected(turns):
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_operator(spark, tokenizer_json):
    odd = "\\### Assistant: </turn> ok"
    told = {
        -7: [("user", odd), ("assistant", odd)],
        1: [("system", "be brief"), ("user", " <|over|>\n<|endoftext|>"), ("assistant", "\n\n  yes é😀 <"), ("assistant", ""), ("assistant", ">ok")],
        2: [("assistant", "word " * 50_000)],
        3: [("user", "")],
    }
    rows = [(i, n, role, text) for i, turns in told.items() for n, (role, text) in enumerate(turns)]
    rows += [(3, None, None, None), (None, 0, "assistant", "alone"), (4, 1, "b", "x"), (4, 1, "a", "y"), (4, 1, "a", "y")]
    told[3].append(("", ""))
    told |= {None: [("assistant", "alone")], 4: [("a", "y"), ("a", "y"), ("b", "x")]}
    table = conversations(spark, rows[::-1]).withColumns({name: F.lit(name) for name in ("turns", "tokens", "n_turns")})
    formatted = chat.format_chats(table, tokenizer_json)
    found = {row.conv_id: (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) for row in chat.read_back(formatted).collect()}
    assert found == {i: expected(turns) for i, turns in told.items()}
    assert chat.read_back(chat.format_chats(table.limit(0), tokenizer_json)).count() == 0


def test_tokens_and_masks(spark, tokenizer_json):
    rows = [(1, 0, "user", "what is it"), (1, 1, "assistant", " a thing<|endoftext|>")]
    (row,) = chat.format_chats(conversations(spark, rows), tokenizer_json).collect()
    offsets = list(zip(row.offsets[::2], row.offsets[1::2]))
    assert len(row.tokens) == len(offsets) == len(row.token_loss)
    assert "".join(row.formatted[start:end] for start, end in offsets) == row.formatted
    (span,) = row.loss_spans
    assert chat.unescaped(row.formatted[span.start : span.end]) == " a thing<|endoftext|>"
    assert [start < span.end and end > span.start for start, end in offsets] == row.token_loss
    # A control string of the vocabulary is spelled out.
    assert 50256 not in row.tokens
