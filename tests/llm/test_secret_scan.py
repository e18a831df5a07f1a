"""Secret scans: base spans against plain patterns, models by held-out strings."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tripkit.llm import queries, secret_scan

PARTS = ["password", "PassWD", "token", "ToKeN", "secret", "api_key", "APIKEY", "ſecret", "toKen", '"', "'", " ", "  ", ":", "=", "AKIA", "ABCDEFGH1234", "0123456789abcdef",
         "deadbeef", "é", "日", ".", "-", "x", "12345678", "\n", "\t", "zzzz", "_"]
#: The patterns as the contract has them, with nothing folded into them.
CONTRACT = {
    "assign": (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE, lambda m: len(m[2]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 32),
}


def plain(text):
    found = [(m.start(), k, m.end()) for k, (pattern, flags, fits) in enumerate(CONTRACT.values()) for m in re.finditer(pattern, text or "", flags) if fits(m)]
    return sorted(found)


def digest(spans):
    return hashlib.sha256(",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans(text):
    assert secret_scan.base_spans(text) == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), min_size=1, max_size=6))
def test_quick_search_misses_nothing(texts):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["spans"])
    got = next(secret_scan.span_batches(iter([batch]), None)).column(0).to_pylist()
    assert [[(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in own] for own in got] == [plain(t) for t in texts]


def words(rng, n):
    syllables = ["con", "ta", "ble", "ing", "re", "user", "name", "get", "set", "list", "tion", "ment", "er", "a", "data", "path"]
    return ["".join(rng.choices(syllables, k=rng.randint(2, 8))) + rng.choice(["", "_id", str(rng.randrange(2000)), "-" + rng.choice(syllables)]) for _ in range(n)]


def keys(rng, n):
    return [base64.b64encode(rng.randbytes(rng.randint(18, 36))).decode().rstrip("=") if k % 2 else rng.randbytes(rng.randint(12, 24)).hex() for k in range(n)]


def test_likelihoods_are_plain_ratios():
    """Scores equal those of a model that looks up each character's counts one by one."""
    rng = random.Random(3)
    samples = {1: keys(rng, 60), 0: words(rng, 300)}
    counts = {}
    for label, strings in samples.items():
        counts[label] = np.zeros(secret_scan.SYMBOLS**2 * secret_scan.LETTERS, np.int64)
        np.add.at(counts[label], secret_scan.transitions(strings)[0], 1)
    model = secret_scan.fit(counts[1], counts[0])

    def likelihood(string, strings):
        total, padded = 0.0, f"^^{string}"
        grams = [f"^^{s}" for s in strings]
        for k in range(2, len(padded)):
            p = 1 / secret_scan.LETTERS
            for n in (0, 1, 2):
                context = padded[k - n : k]
                seen = [g[j] for g in grams for j in range(2, len(g)) if g[j - n : j] == context]
                p = (seen.count(padded[k]) + secret_scan.PRIOR * p) / (len(seen) + secret_scan.PRIOR)
            total += np.log(p)
        return total

    for string in [*words(rng, 3), *keys(rng, 2), "a"]:
        assert np.isclose(model.scores([string])[0], likelihood(string, samples[1]) - likelihood(string, samples[0]))


def test_held_out_strings(spark):
    rng = random.Random(4)
    rows = [(s, 1) for s in keys(rng, 400)] + [(s, 0) for s in words(rng, 4000)] + [(None, 1), ("x", None), ("é", 1), ("", 0)]
    model = secret_scan.learn(spark.createDataFrame(rows, "string string, label int").repartition(3))
    found, ordinary = keys(rng, 300), [w for w in words(rng, 3000) if len(w) >= secret_scan.LEAST_RUN]
    assert (model.scores(found) >= model.threshold).mean() > 0.95
    assert (model.scores(ordinary) >= model.threshold).mean() < 0.001


def test_added_spans_and_edges(spark, edge_docs, edge_rows, no_docs):
    rng = random.Random(5)
    rows = [(s, 1) for s in keys(rng, 400)] + [(s, 0) for s in words(rng, 4000)]
    model = secret_scan.learn(spark.createDataFrame(rows, "string string, label int"))
    key, own = keys(rng, 2)[1], keys(rng, 2)[0]
    texts = [f"é {key} end", f'token = "{own}" and {key}', " ".join(words(rng, 50)), None, "", "AKIA" + "A1" * 8, f"{key}." * 3]
    docs = spark.createDataFrame([(k, t, "old") for k, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.find_secrets(docs, model).collect()}
    assert got[0] == [("random", 2, 2 + len(key))]
    assert got[1][0] == ("assign", 0, len('token = "') + len(own)) and got[1][-1][0] == "random" and got[1][-1][1] == texts[1].index(key)
    assert got[2] == got[3] == got[4] == [] and got[5] == [("access", 0, 20)]
    assert got[6] == [("random", k * (len(key) + 1), k * (len(key) + 1) + len(key)) for k in range(3)]
    edge = secret_scan.find_secrets(edge_docs, model)
    assert edge.columns == [*edge_docs.columns, "spans"] and edge.count() == len(edge_rows)
    assert secret_scan.find_secrets(no_docs, model).collect() == []
    nothing = secret_scan.learn(secret_scan.labelled_strings(no_docs))
    assert abs(nothing.scores(["abc"])[0]) < 1e-9


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_secret_scan(spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for key, text in texts.items():
        spans, row = plain(text), got[key]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert row.base_sha256 == digest(spans)
        listed = [x for x in row.spans.split(",") if x]
        assert [x for x in listed if not x.startswith("random")] == [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans]
