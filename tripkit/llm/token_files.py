"""Token ids of a corpus in files: one wavelet matrix per shard of whole documents.

Documents are dealt out by ranges of their ids and encoded in order; a task closes a shard when
it holds ``SHARD_TOKENS`` ids. A shard is one row and one compressed Parquet file: its place in
the order, its documents' ids and lengths, and the bit planes with their rank directory, from
which any token, count or occurrence is read without decoding the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.columnar import pieces, row_keys
from tripkit.llm.tokens import encoder
from tripkit.llm.wavelet import WaveletMatrix

#: Ids of a shard; a longer document has a shard of its own.
SHARD_TOKENS = 1 << 20
#: Bytes of text that are encoded at a time.
STEP_BYTES = 8 << 20


def shard_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    own, part, before, size = encoder(path), TaskContext.get().partitionId(), 0, 0
    ids: list[pa.Array] = []
    tokens: list[np.ndarray] = []
    counts: list[int] = []

    def close() -> pa.RecordBatch:
        matrix = WaveletMatrix.build(np.concatenate(tokens))
        values = [[part], [before], [matrix.n]]
        names = pa.chunked_array(ids).combine_chunks()
        lists = [pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), pa.array([counts], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.int64()), strict=True)), *lists,
             pa.array([matrix.to_bytes()], pa.binary())], names=["part", "before", "n_tokens", "ids", "lengths", "matrix"])

    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
        for low, high in pieces(np.r_[0, np.cumsum(sizes)], STEP_BYTES):
            found, limits = own.encode_column(batch.column(1).slice(low, high - low))
            for k in range(high - low):
                encoded = np.append(found[limits[k] : limits[k + 1]], np.uint32(end_id)).astype(np.uint32)
                if tokens and size + len(encoded) > shard_tokens:
                    yield close()
                    ids, tokens, counts, size, before = [], [], [], 0, before + size
                ids.append(batch.column(0).slice(low + k, 1))
                tokens.append(encoded)
                counts.append(len(encoded))
                size += len(encoded)
    if tokens:
        yield close()


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
                 text_column: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every whole text (null: empty), add ``end_id``, and write shards in ascending id order.

    Null ids come first; rows of equal ids stand in the order of a hash of their text, so none
    needs to share a task with all others of its id. Other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    ordered = (docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
                           *row_keys(id_column, text_column))
               .repartitionByRange("_id", "_key_a", "_key_b").sortWithinPartitions("_id", "_key_a", "_key_b"))
    shards = ordered.select("_id", "_text").mapInArrow(
        partial(shard_batches, path=tokenizer, end_id=end_id, shard_tokens=shard_tokens),
        f"part int, before bigint, n_tokens bigint, ids array<{kind}>, lengths array<bigint>, matrix binary")
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with their first token's place in the whole order as start."""
    shards = spark.read.parquet(folder)
    totals = sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_tokens")).collect())
    firsts = accumulate([0, *(n for _, n in totals)])
    # one row per task that wrote; a shard knows how many ids its own task wrote before it
    offsets = spark.createDataFrame([(p, first) for (p, _), first in zip(totals, firsts, strict=False)], "part int, _first bigint")
    return shards.join(F.broadcast(offsets), "part").withColumn("start", F.col("_first") + F.col("before")).drop("_first")


def document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of each shard: id, start, n_tokens, checksum, decoded from the matrix."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, lengths = (batch.column(c)[k].values for c in (0, 1))
            counts = lengths.to_numpy(zero_copy_only=False)
            limits = np.r_[0, np.cumsum(counts)]
            tokens = WaveletMatrix.from_bytes(batch.column(3)[k].as_py()).all().astype("<u4")
            sums = [zlib.crc32(tokens[s:e]) for s, e in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(limits[:-1] + batch.column(2)[k].as_py(), pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(sums, pa.int64())], names=["_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = read_shards(spark, folder)
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    found = shards.select("ids", "lengths", "start", "matrix").mapInArrow(
        document_batches, f"_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.withColumnRenamed("_id", id_column)
