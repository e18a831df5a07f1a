"""Containment search against comparing every document with every item."""

from __future__ import annotations

import random

import numpy as np

from tripkit.llm import decontamination as d


def brute(docs, items, threshold=0.8):
    parts = [(k, d.normal_words((t or "").encode())) for k, t in docs]
    found = []
    for item, text in items:
        words = d.normal_words((text or "").encode())
        own = d.shingles(words, 5)
        sets = [(k, d.shingles(p, min(5, len(words)))) for k, p in parts] if words else []
        for key, held in sets:
            if own and len(own & held) / len(own) >= threshold:
                found.append((key, item, len(own), len(own & held), len(own & held) / len(own)))
    return sorted(found, key=str)


def words(rng, n):
    return " ".join(f"t{rng.randrange(4000)}" for _ in range(n))


def test_equals_brute_force(spark, edge_docs, edge_rows):
    rng = random.Random(8)
    items = [(k, words(rng, n)) for k, n in enumerate([5, 6, 9, 30, 60, 400, 3000])]
    items += [(20, None), (21, ""), (22, "One"), (23, "é ß 日本 x"), (24, edge_rows[4][1]), (24, edge_rows[4][1]), (None, "SAME, same!" * 3)]
    rows = list(edge_rows)
    for k, (item, text) in enumerate(items[:7]):
        parts = text.split()
        rows += [(100 + k, words(rng, 5000) + " " + text.upper().replace(" ", ", ") + ". " + words(rng, 50)),
                 (200 + k, words(rng, 20) + " " + " ".join(parts[: max(1, len(parts) * 17 // 20)])),
                 (300 + k, " ".join(parts[: len(parts) // 2])),
                 (400 + k, " ".join(p if j % 60 else "changed" for j, p in enumerate(parts, 30)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS _id", "2 AS _item", "'n' AS n_shingles").repartition(4)
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "3 AS containment")
    got = sorted((tuple(r) for r in d.contained_items(docs, bench).collect()), key=str)
    want = brute(rows, items)
    assert got == want and len(want) > 25
    clean = d.without_items(docs, bench)
    assert clean.columns == docs.columns
    dirty = {(k, t) for k, t in rows if any(w[0] == k and brute([(k, t)], items) for w in want)}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(k) for k, t in rows if (k, t) not in dirty)


def test_blocks_of_items_and_empty_tables(spark, monkeypatch):
    rng = random.Random(9)
    items = [(k, words(rng, 20)) for k in range(30)]
    rows = [(k, words(rng, 30) + " " + items[k][1]) for k in range(30)]
    monkeypatch.setattr(d, "ITEM_BYTES", 300)
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in d.contained_items(docs, bench).collect()) == [(k, k) for k in range(30)]
    assert d.without_items(docs, bench).collect() == []
    assert d.contained_items(docs.limit(0), bench).collect() == d.contained_items(docs, bench.limit(0)).collect() == []
    assert d.without_items(docs, bench.limit(0)).count() == 30


def test_short_items_inside_long_documents(spark):
    rng = random.Random(10)
    items = [(1, "alpha"), (2, "Alpha, beta"), (3, "alpha beta gamma"), (4, "alpha beta gamma delta"), (5, "alpha beta gamma delta epsilon"), (6, "omega")]
    rows = [(1, "x y z alpha beta gamma delta w v u"), (2, "alpha beta gamma delta epsilon"), (3, "alpha"), (4, "beta alpha"), (5, "gamma delta alpha beta"),
            (6, words(rng, 3000) + " ALPHA; beta " + words(rng, 3000)), (7, "alphabet beta gamma delta"), (8, ""), (9, None), (10, words(rng, 4)), (11, "alpha " * 500)]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in d.contained_items(docs, bench).collect()), key=str)
    assert got == brute(rows, items)
    assert {(1, 4), (5, 2), (6, 2), (11, 1)} <= {g[:2] for g in got} and (1, 5) not in {g[:2] for g in got}
    assert sorted(r.doc_id for r in d.without_items(docs, bench).collect()) == [7, 8, 9, 10]
    own = spark.createDataFrame([(4, "alpha beta gamma delta")], "item_id bigint, text string")
    assert sorted(r.doc_id for r in d.contained_items(docs, own).collect()) == [1, 2]


def test_sql_takes_short_items_alike(spark):
    import duckdb

    from tripkit.llm.queries import OP7_SQL

    rows = [(1, "x alpha beta gamma delta w v"), (2, "Alpha"), (3, None), (4, ""), (5, "alpha beta gamma delta epsilon zeta")]
    items = [(1, "alpha"), (2, "alpha beta gamma delta"), (3, "alpha beta gamma delta epsilon"), (4, None)]
    db = duckdb.connect()
    for name, key, values in (("documents", "doc_id", rows), ("benchmark", "item_id", items)):
        db.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        db.executemany(f"INSERT INTO {name} VALUES (?, ?)", values)
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(tuple(r) for r in d.contained_items(docs, bench).collect())
    assert got == sorted(db.execute(OP7_SQL).fetchall()) == sorted(brute(rows, items))


def test_shingle_hashes_follow_words():
    rng = random.Random(1)
    texts = [words(rng, n).encode() for n in (0, 1, 3, 5, 6, 40, 0, 12)]
    limits = np.r_[0, np.cumsum([len(t) for t in texts])]
    hashes, owner = d.shingle_hashes(np.frombuffer(b"".join(texts), np.uint8), limits, 5)
    counts = [0, 1, 1, 1, 2, 36, 0, 8]
    assert np.bincount(owner, minlength=8).tolist() == counts
    alone = np.concatenate([d.shingle_hashes(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 5)[0] for t in texts])
    assert np.array_equal(hashes, alone)
