"""Token ids, wavelet matrices, token files and packing."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripkit.llm import packing, token_files
from tripkit.llm.tokens import encoder
from tripkit.llm.wavelet import WaveletMatrix
from tripkit.session import shared_path

LIBRARIES: dict = {}
PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]
LETTERS = "ab zé'ÉÀß \t\n\r.,!?'sStT09<|>½²ªº \u0085 ́日ſİ"


@pytest.mark.parametrize("path", PATHS)
@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from(LETTERS), max_size=40))
def test_ids_are_the_librarys(path, text):
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids if len(text) < 3 else None
    own = encoder(path)
    want = want or own.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == want


@pytest.mark.parametrize("path", PATHS)
def test_every_plain_character_alone_and_between_others(path):
    own = encoder(path)
    for code in [*range(9, 14), *range(28, 256)]:
        for text in (chr(code), f"a{chr(code)}b", f" {chr(code)} {chr(code)}{chr(code)}1", f"'{chr(code)}s"):
            assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_special_tokens_and_long_memory(monkeypatch):
    from tripkit.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    own = tokens.Encoder(PATHS[0])
    for text in ("a<|endoftext|>b", "one two three four five one two six seven one " * 3):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300) | st.lists(st.integers(0, 3), max_size=1500))
def test_wavelet_matrix(symbols):
    held = WaveletMatrix.from_bytes(WaveletMatrix.build(np.array(symbols, np.uint32)).to_bytes())
    assert held.all().tolist() == symbols
    for i in range(0, len(symbols), 37):
        assert held.access(i) == symbols[i]
    for symbol in {*symbols[:5], 1, 99_999}:
        places = [i for i, s in enumerate(symbols) if s == symbol]
        assert held.count(symbol) == len(places)
        assert held.count(symbol, len(symbols) // 2) == sum(p < len(symbols) // 2 for p in places)
        assert [held.select(symbol, k) for k in range(0, len(places), 7)] == places[::7]
        assert held.select(symbol, len(places)) == held.select(symbol, -1) == -1


def ids_of(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end]


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, edge_docs, edge_rows):
    folder = shared_path(spark, "tokens")
    token_files.write_tokens(edge_docs, folder, PATHS[0], end_id=2, shard_tokens=500)
    shards = spark.read.parquet(folder)
    assert shards.count() > 5 and shards.select("part", "before").distinct().count() == shards.count()
    got = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((k for k, _ in edge_rows), key=lambda k: (k is not None, k or 0))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    want = sorted((str(k), len(i := ids_of(PATHS[0], t, 2)), checksum(i)) for k, t in edge_rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want


def test_token_files_of_no_documents(spark, no_docs):
    folder = shared_path(spark, "tokens")
    token_files.write_tokens(no_docs, folder, PATHS[0], end_id=2)
    assert token_files.read_documents(spark, folder).collect() == []


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packed_documents(edge_docs, edge_rows, capacity):
    got = packing.pack_documents(edge_docs, PATHS[1], capacity=capacity).collect()
    check_packing(got, capacity)
    want = []
    for key, text in edge_rows:
        ids = ids_of(PATHS[1], text, 1)
        want += [(str(key), k, a, len(ids[a : a + capacity]), checksum(ids[a : a + capacity])) for k, a in enumerate(range(0, len(ids), capacity))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got)


def test_packing_is_tight_over_many_partitions(spark):
    rng = random.Random(1)
    lengths = [rng.choice([rng.randrange(1, 300), rng.randrange(300, 1001)]) for _ in range(6000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item bigint, length bigint").repartition(30)
    placed = packing.pack(items, 1000).join(items, "item").collect()
    assert sorted(r.item for r in placed) == list(range(6000))
    assert check_packing(placed, 1000) <= 1.01 * math.ceil(sum(lengths) / 1000) + 1


def test_items_that_cannot_be_joined_stay_apart(spark):
    items = spark.range(500).selectExpr("id AS item", "CAST(600 AS BIGINT) AS length").repartition(20)
    placed = packing.pack(items, 1000).collect()
    assert len({r.sequence_id for r in placed}) == 500 and {r.offset for r in placed} == {0}


def test_packing_nothing(no_docs):
    assert packing.pack_documents(no_docs, PATHS[1]).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(
    ["a", " ", "  ", "\n", "\r\n", "\t", "eau", "É", "日本", "😀", "<|endoftext|>", "<|", "'s", "12", "\x00", "\u3000", "\xa0", "\x1c", "."]), max_size=10).map("".join)), max_size=6))
def test_columns_of_texts(texts):
    for path in PATHS:
        library = LIBRARIES.setdefault(path, Tokenizer.from_file(path))
        ids, limits = encoder(path).encode_column(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(limits, limits[1:], strict=False)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
