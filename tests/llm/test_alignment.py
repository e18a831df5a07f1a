"""Cross-tokenizer alignment against a plain version that walks over bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict, deque

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import public_tokenizers
from tripkit.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MODEL, LIBRARY = SentencePieceProcessor(model_file=B), Tokenizer.from_file(A)
LIBRARY.encode_special_tokens = True
OWN = alignment.Aligner(A, B)
PARTS = ["a", " ", "  ", "\n", "\r\n", "\t", "eau", "Éa", "日本", "😀", "é", "</s>", "<s>", "<unk>", "<|endoftext|>", "<0x41>", ".", "()", "'s", "12", "\x00", "▁", "　", "Ġ", "ſ"]


def plain_ids(text):
    """Both id lists with the bytes of each token, or None where a text has no tokens."""
    if not text:
        return None
    back = {c: b for b, c in enumerate_printed()}
    a = [(k, bytes(back[c] for c in LIBRARY.id_to_token(k))) for k in LIBRARY.encode(f" {text}", add_special_tokens=False).ids]
    b = [(k, bytes([int(MODEL.id_to_piece(k)[3:5], 16)]) if MODEL.is_byte(k) else MODEL.id_to_piece(k).replace("▁", " ").encode())
         for k in MODEL.encode(text)]
    whole = f" {text}".encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None


def enumerate_printed():
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return [(b, chr(b)) for b in printed] + [(b, chr(256 + k)) for k, b in enumerate(rest)]


def plain_groups(tokens):
    groups, a, b, left, right = [], deque(tokens[0]), deque(tokens[1]), 0, 0
    own, other = [], []
    while a or b:
        if left <= right and a:
            k, data = a.popleft()
            own.append(k)
            left += len(data)
        else:
            k, data = b.popleft()
            other.append(k)
            right += len(data)
        if left == right and own and other:
            groups.append((own, other))
            own, other = [], []
    return groups


def brute(rows):
    found = [(key, plain_groups(t) if (t := plain_ids(text)) else None) for key, text in rows]
    count = Counter(p for _, groups in found if groups for p in {(x, y) for own, other in groups for x in own for y in other})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for key, groups in found:
        if groups is None:
            out.append((key, 0, 0, 0, 0, "", 0, 0))
            continue
        links = [(x, y) for own, other in groups for x in own for y in other]
        written = ";".join(f"{','.join(map(str, own))}|{','.join(map(str, other))}" for own, other in groups)
        out.append((key, sum(len(o) for o, _ in groups), sum(len(o) for _, o in groups), len(groups), len(links),
                    hashlib.sha256(written.encode()).hexdigest(), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)))
    return out


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, *(r if r[0] is not None else (0, *r[1:]))))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_ids_are_the_libraries(text):
    assert OWN.split
    data = np.frombuffer(f" {text}".encode(), np.uint8)
    starts = OWN.starts(data, np.array([0, len(data)]), pa.array([text])).tolist()
    parts = [data[low:high].tobytes().decode() for low, high in zip(starts, [*starts[1:], len(data)], strict=True)]
    if text:
        assert [k for ids in OWN.b.encode(parts) for k in ids] == MODEL.encode(text)
    assert np.frombuffer(b"".join(map(OWN.a.encode, parts)), "<u4").tolist() == LIBRARY.encode(f" {text}", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(0, 1000), st.integers(1, 9))
def test_groups_of_any_cuts(sizes, seed, step):
    """Ends in steps of any size and large groups give the links of the plain walk."""
    rng = random.Random(seed)
    total, b_sizes = sum(sizes), []
    while sum(b_sizes) < total:
        b_sizes.append(min(rng.randint(1, 5), total - sum(b_sizes)))
    a, b = (np.array([rng.randrange(4) for _ in x], np.uint64) for x in (sizes, b_sizes))
    cuts = alignment.common_ends(np.cumsum(sizes), np.cumsum(b_sizes), step)
    groups = plain_groups(([(int(k), b"x" * n) for k, n in zip(a, sizes, strict=True)], [(int(k), b"x" * n) for k, n in zip(b, b_sizes, strict=True)]))
    assert len(groups) == len(cuts[0])
    want = Counter((x << 32) + y for own, other in groups for x in own for y in other)
    for limit in (1, 4, alignment.LARGE):
        alignment.LARGE, kept = limit, alignment.LARGE
        pairs, links, limits = alignment.linked(a, b, *cuts)
        alignment.LARGE = kept
        for (own, other), low, high in zip(groups, limits, limits[1:], strict=False):
            got = dict(zip(*(x.tolist() for x in alignment.distinct(pairs[low:high], links[low:high])), strict=True))
            assert got == Counter((x << 32) + y for x in own for y in other)
        assert dict(zip(*(x.tolist() for x in alignment.distinct(pairs, links)), strict=True)) == want


def test_tables(spark, edge_docs, edge_rows, no_docs, sf_dir):
    rows = [*edge_rows, (20, "</s> <|endoftext|> x"), (21, "with ▁ inside"), (22, " leading"), (23, "\n"), (24, "a" * 3000 + " " * 999 + "\x00"), (25, "日本😀é" * 40)]
    docs = spark.createDataFrame([(k, t, 1, "x", None) for k, t in rows], "doc_id bigint, text string, chunk int, pairs string, n int").repartition(3)
    for size in (1, 4000, alignment.CHUNK_BYTES):
        assert by_key(alignment.align(docs, A, B, chunk_bytes=size).collect()) == by_key(brute(rows))
    assert alignment.align(no_docs, A, B).collect() == []
    assert by_key(alignment.align(edge_docs, A, B).collect()) == by_key(brute(edge_rows))


def test_small_steps(monkeypatch):
    """Long texts in parts, stretches learnt one by one."""
    rng = random.Random(7)
    texts = [None, "", *("".join(rng.choices(PARTS, k=rng.randrange(400))) for _ in range(30)), "x" * 999, "one two " * 50]
    for step in (1, 7, 100_000):
        monkeypatch.setattr(alignment, "STEP_STRETCHES", step)
        assert [fact for fact, _, _ in OWN.facts(pa.array(texts))] == [r[1:6] for r in brute(list(enumerate(texts)))]


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    names = ["doc_id", *alignment.FACTS, "n_best", "count_sum"]
    got = queries.op11_cross_tokenizer_alignment(spark, sf_dir).select(*names).collect()
    assert by_key(got) == by_key(brute(rows))


