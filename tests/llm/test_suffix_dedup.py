"""Suffix-array deduplication against counting every string, and its arrays against definitions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripkit.llm import suffix_dedup
from tripkit.llm.suffixes import longest_previous, nearest_smaller


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60))
def test_nearest_smaller(values):
    got = nearest_smaller(np.array(values, np.int64))
    # equal entries do not occur in suffix order; an equal one counts as reached here
    want = [max((j for j in range(i) if values[j] <= values[i]), default=-1) for i in range(len(values))]
    assert got.tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=120), st.sampled_from([8, 13, 16, 40]))
def test_longest_previous_reaches_depth_iff_an_earlier_copy_does(text, depth):
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.arange(max(0, len(text) - depth + 1))
    length, source = longest_previous(data, starts, depth)
    for i in starts:
        earlier = [j for j in range(i) if text[j : j + depth] == text[i : i + depth]]
        assert (length[i] >= depth) == bool(earlier)
        assert not earlier or source[i] in earlier
        assert source[i] < i


def order(key):
    return (key is not None, key or 0)


def brute(rows, length, keep_first=False):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    seen, out = set(), []
    for k in sorted(range(len(rows)), key=lambda k: order(rows[k][0])):
        b = data[k]
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                if not keep_first or b[i : i + length] in seen:
                    gone[i : i + length] = True
                seen.add(b[i : i + length])
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((rows[k][0], len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), kept))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans) // 16, bytes(r.kept)) for r in df.collect()), key=str)


@pytest.mark.parametrize("crowd", [0, 1000])
@pytest.mark.parametrize("length", [40, 400])
def test_equals_brute_force(edge_docs, edge_rows, length, crowd):
    rows = [r for r in edge_rows if len(r[1] or "") < 50_000]
    docs = edge_docs.where("text IS NULL OR length(text) < 50000")
    assert result(suffix_dedup.remove_repeated_bytes(docs, length=length, crowd=crowd)) == brute(rows, length)


@pytest.mark.parametrize("crowd", [0, 1000])
def test_keeps_the_first_copy(spark, crowd):
    rows = [(k, f"{'x' * (k % 9)}{'The quick brown fox jumps over it. ' * (1 + k % 2)}{k * 'ab'}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = result(suffix_dedup.remove_repeated_bytes(docs, length=16, keep_first=True, crowd=crowd))
    assert got == brute(rows, 16, keep_first=True)


def test_long_texts_are_taken_in_sections(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = suffix_dedup.anchored(data, np.array([0, 5000]), 50)
    monkeypatch.setattr(suffix_dedup, "SECTION", 700)
    parts = suffix_dedup.anchored(data, np.array([0, 5000]), 50)
    assert set(zip(*(x.tolist() for x in whole), strict=True)) == set(zip(*(x.tolist() for x in parts), strict=True))


def test_empty_table(no_docs):
    assert suffix_dedup.remove_repeated_bytes(no_docs).collect() == []
