"""The pipeline against its stages done by brute force on the small driver table."""

from __future__ import annotations

import sys

import numpy as np

import corpus_pipeline
from tripkit.llm import decontamination, queries

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from test_near_duplicates import fingerprint, least_reachable  # noqa: E402
from test_substring import brute  # noqa: E402
from test_tokens import check_packing, checksum, ids_of  # noqa: E402


def test_run_equals_its_stages_by_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest with toxic documents enough to learn from
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = {r.doc_id for r in queries.op4_toxicity(spark, sf_dir).where("score >= 0.3").collect()}
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect() if r.doc_id not in toxic]
    assert 0 < len(toxic) < 0.2 * docs.count()

    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    pairs = [(i, int(j)) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2) if j > i]
    rows = [r for k, (r, least) in enumerate(zip(rows, least_reachable(len(rows), pairs), strict=True)) if k == least]

    kept = {k: (removed, text) for k, _, removed, text in brute(rows, 35)}
    rows = [(k, kept[k][1] if kept[k][0] else t) for k, t in rows if not kept[k][0] or kept[k][1]]

    items = [d for i in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
             if (d := decontamination.shingles(decontamination.normal_words(i.text.encode()), 5))]
    own = [decontamination.shingles(decontamination.normal_words(t.encode()), 5) for _, t in rows]
    rows = [r for r, s in zip(rows, own, strict=True) if not any(len(i & s) / len(i) >= 0.8 for i in items)]

    want = []
    for key, text in rows:
        ids = ids_of(queries.WORD_TOKENIZER, text, 1)
        want += [(key, n, a, len(ids[a : a + 4096]), checksum(ids[a : a + 4096])) for n, a in enumerate(range(0, len(ids), 4096))]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert check_packing(got, 4096) <= 1.02 * sum(w[3] for w in want) / 4096 + 1


def test_stages_keep_columns_and_bear_odd_rows(spark, sf_dir, edge_docs):
    docs = edge_docs.selectExpr("doc_id", "text", "'xx' AS lang", "CAST(NULL AS STRING) AS source", "CAST(length(text) AS BIGINT) AS n_chars", "1 AS _score")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            assert out.columns == docs.columns and out.count() <= table.count()
        assert (corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).count() == 0) == (table.count() == 0)
