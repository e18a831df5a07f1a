"""SimHash classes, vector links and components against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tripkit.llm import projection, simhash
from tripkit.llm.components import connected_components


def least_reachable(n, pairs):
    label = list(range(n))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(300, 360)] + [(400, k) for k in range(401, 460)]
    edges = spark.createDataFrame([*pairs, pairs[0], (7, 7), (None, 3)], "u bigint, v bigint")
    want = least_reachable(460, pairs)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {n: want[n] for n in {x for p in pairs for x in p if p[0] != p[1]}}
    assert connected_components(edges.limit(0)).count() == 0


def fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    pairs = [(i, int(j)) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2) if j > i]
    label = least_reachable(len(rows), pairs)
    least = {}
    for k, (key, _) in enumerate(rows):
        ids = [x for x in (least.get(label[k]), key) if x is not None]
        least[label[k]] = min(ids, default=None)
    return prints, label, [least[x] for x in label]


def test_simhash_edge_rows(edge_docs, edge_rows):
    prints, label, least = brute_classes(edge_rows)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(edge_docs).collect()), key=str)
    assert got == sorted(((k, int(f), c) for (k, _), f, c in zip(edge_rows, prints, least, strict=True)), key=str)
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (c for c in {k: v for k, v in zip(label, least, strict=True)}.values()), key=str)


def test_simhash_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.one_of_each(no_docs).collect() == []


@pytest.mark.parametrize("shard", [8, 100, 4000])
def test_links_in_random_and_dense_fingerprints(spark, shard):
    rng = np.random.default_rng(shard)
    loose = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = np.concatenate([loose[:60] ^ (np.uint64(1) << rng.integers(0, 63, 60, dtype=np.uint64)) for _ in range(3)])
    dense = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 40, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 40, 300, dtype=np.uint64))
    points = np.unique(np.concatenate([loose, near, dense, dense ^ np.uint64(1 << 50)]))
    pairs = [(i, int(j)) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2) if j > i]
    want = least_reachable(len(points), pairs)
    classes = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp bigint")
    place = {int(p): k for k, p in enumerate(points.view(np.int64))}
    edges = [(place[r.u], place[r.v]) for r in simhash.fingerprint_links(classes, sample=256, shard=shard).collect()]
    assert least_reachable(len(points), edges) == want


def brute_vectors(rows, cosine=0.9):
    units = []
    for _, v in rows:
        x = None if v is None or not v or any(c is None for c in v) else np.array(v, float)
        if x is not None and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            units.append(x / np.sqrt(x @ x))
        else:
            units.append(None)
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine]
    label = least_reachable(len(rows), pairs)
    degree = np.bincount(np.array(pairs, int).ravel(), minlength=len(rows))
    return [(rows[k][0], int(degree[k]), rows[label[k]][0], label[k] == k) for k in range(len(rows))]


def test_vector_links(spark):
    rng = np.random.default_rng(4)
    loose = rng.standard_normal((150, 16))
    tight = np.concatenate([rng.standard_normal(16) + s * rng.standard_normal((n, 16)) for s, n in ((0.02, 90), (0.2, 60), (0.5, 40))])
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1e-300] * 16, [1e300] * 16, [1.0] * 8]
    rows = [(k, v) for k, v in enumerate([*loose.tolist(), *tight.tolist(), *tight[:5].tolist(), *odd])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS node", "'x' AS unit").repartition(4)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in projection.near_duplicate_vectors(vectors).collect())
    want = sorted(brute_vectors(rows))
    found, all_ = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.97 * all_ and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[2:] != w[2:] for g, w in zip(got, want, strict=True)) <= 3
    assert [g[1] for g in got if 150 <= g[0] < 240] == [w[1] for w in want if 150 <= w[0] < 240]


def cone(rng, n, spread, size=64):
    """Directions about one axis; two of them differ by a cosine of about 1 / (1 + spread ** 2)."""
    x = rng.standard_normal(size)
    x = x / np.linalg.norm(x) + spread / np.sqrt(size) * rng.standard_normal((n, size))
    return x / np.linalg.norm(x, axis=1)[:, None]


def vector_table(spark, x):
    return spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float64()))})).repartition(8)


def counts_and_components(x, cosine=0.9):
    degree, label = np.zeros(len(x), np.int64), np.arange(len(x))
    for a in range(0, len(x), 1024):
        linked = x[a : a + 1024] @ x.T >= cosine
        degree[a : a + 1024] = linked.sum(axis=1) - 1
        for k, row in enumerate(linked):
            mine = np.unique(label[row | (np.arange(len(x)) == a + k)])
            if len(mine) > 1:
                label[np.isin(label, mine)] = mine[0]
    return degree, label


@pytest.mark.parametrize("n, spread", [(20000, 0.27), (3000, 0.33)])
def test_dense_cones_lose_no_link(spark, n, spread):
    rng = np.random.default_rng(n)
    x = np.concatenate([cone(rng, n, spread), cone(rng, 300, 0.1), rng.standard_normal((700, 64))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = np.concatenate([x, x[:40]])  # equal vectors count as vectors of their own
    degree, label = counts_and_components(x)
    assert degree[:n].mean() > (n * 0.9 if spread < 0.3 else n * 0.1)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in projection.near_duplicate_vectors(vector_table(spark, x)).collect())
    links = np.array([g[1] for g in got])
    assert (links <= degree).all() and links.sum() >= 0.98 * degree.sum()
    assert np.mean([g[2] for g in got] == label) > 0.98


def test_stripes_of_a_region(spark, monkeypatch):
    monkeypatch.setattr(projection, "STEP", 50)
    rng = np.random.default_rng(8)
    x = np.concatenate([cone(rng, 300, 0.3, 16), cone(rng, 200, 0.35, 16)])
    degree, label = counts_and_components(x)
    for low, high in ((0, 0), (0, 1)):
        stripe = np.zeros(500, np.int64) if low == high else np.arange(500) % 2
        group = pa.table({"cid": np.arange(500), "radius": np.zeros(500), "n": np.ones(500, np.int64), "stripe": stripe,
                          "low": np.full(500, low), "high": np.full(500, high), "unit": pa.array([v.tobytes() for v in x], pa.binary())})
        rows = projection.striped(group, 0.9).to_pylist()
        linked = (x @ x.T >= 0.9) & ~np.eye(500, dtype=bool)
        if low != high:
            linked &= stripe[:, None] != stripe[None, :]
        assert {r["a_id"]: r["more"] for r in rows if r["kind"] == projection.COUNT} == {k: v for k, v in enumerate(linked.sum(axis=1)) if v}
        edges = [(r["a_id"], r["b_id"]) for r in rows if r["kind"] == projection.LINK]
        assert all(linked[a, b] for a, b in edges) and len(edges) < 500
        assert least_reachable(500, edges) == least_reachable(500, list(zip(*np.nonzero(linked), strict=True)))


def test_passes_grow_with_the_centres():
    limit = float(np.arccos(0.9))
    assert [projection.passes_for(n, limit) for n in (0, 1000, 10**5, 10**6)] == [16] * 4
    assert 20 < projection.passes_for(10**7, limit) < projection.passes_for(10**8, limit) < projection.passes_for(10**9, limit) < 90


def test_vectors_empty_and_null_ids(spark):
    vectors = spark.createDataFrame([(None, [1.0, 0.0]), (None, None), (3, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert projection.near_duplicate_vectors(vectors.limit(0)).collect() == []
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in projection.near_duplicate_vectors(vectors).collect()), key=str)
    assert got == [(3, 1, 3), (None, 0, None), (None, 1, 3)]
