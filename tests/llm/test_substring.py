"""Substring deduplication against counting every window."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tripkit.llm import substring


def per_row(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    for w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        yield len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()


def brute(rows, window):
    return sorted(((key, *found) for (key, _), found in zip(rows, per_row(rows, window), strict=True)), key=str)


@pytest.mark.parametrize("window", [1, 3, 35])
def test_equals_brute_force(edge_docs, edge_rows, window):
    got = substring.remove_repeated_windows(edge_docs, window=window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(edge_rows, window)


def test_spans_are_maximal(edge_docs):
    for r in substring.remove_repeated_windows(edge_docs, window=35).collect():
        spans = np.frombuffer(r.spans, "<i4").reshape(-1, 2)
        assert (spans[1:, 0] > spans[:-1, 1]).all() and (spans[:, 1] - spans[:, 0]).sum() == r.n_removed


def test_other_columns_stay(edge_docs, edge_rows):
    kept = substring.without_repeated_windows(edge_docs, window=35)
    assert kept.columns == edge_docs.columns
    want = Counter((k, w if n else t) for (k, t), (_, n, w) in zip(edge_rows, per_row(edge_rows, 35), strict=True) if w or not n)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want


def test_empty_table(no_docs):
    assert substring.remove_repeated_windows(no_docs).collect() == []
    assert substring.without_repeated_windows(no_docs).collect() == []


def test_many_small_chunks_and_buckets(spark, monkeypatch):
    from tripkit.llm import exchange

    rows = [(k, f"a{k % 7} b c d{k % 3} e f g h{k}") for k in range(400)]
    monkeypatch.setattr(exchange, "BUCKET_VALUES", 50)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    got = substring.remove_repeated_windows(docs, window=4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, 4)
