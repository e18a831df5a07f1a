"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import public_tokenizers
from tripkit.llm import alignment, chat, decontamination, packing, prefix_trie, projection, quality, secret_scan, simhash, substring, suffix_dedup, token_files, toxicity
from tripkit.llm.ship import ship
from tripkit.session import materialize, shared_path

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Words outside repeated 35-word windows, per document."""
    kept = substring.remove_repeated_windows(read(spark, sf, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    packed = packing.pack_documents(read(spark, sf, "documents"), WORD_TOKENIZER, end_id=1, capacity=4096, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from wavelet matrix files."""
    folder = shared_path(spark, "tokens")
    token_files.write_tokens(read(spark, sf, "documents"), folder, BYTE_TOKENIZER, end_id=2)
    return token_files.read_documents(spark, folder)


def held_out(column: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of every document, learned from three quarters of the labels."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, read(spark, sf, "labels").where(~held_out()))
    scored = toxicity.score(docs, model).withColumn("held_out", held_out())
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes outside repeated 400-byte strings, per document."""
    kept = suffix_dedup.remove_repeated_bytes(read(spark, sf, "documents"), length=400)
    return kept.select("doc_id", "n_bytes", "n_removed", (F.octet_length("spans") / 16).cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op6_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Links and near-duplicate class of every vector."""
    return projection.near_duplicate_vectors(read(spark, sf, "embeddings"))


def op7_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a document and a test item of which it contains 0.8 or more."""
    return decontamination.contained_items(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


#: Words of a table's texts, as in ``decontamination.normal_words``; distinct runs of k of them.
ITEM_WORDS = r"""
    SELECT {id}, w, least(len(w), 5) AS k FROM
          (SELECT {id}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM {table}) WHERE len(w) > 0"""
RUNS = """
    SELECT DISTINCT {id}, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
    FROM (SELECT {id}, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM {words})"""
OP7_SQL = f"""
    WITH dw AS ({ITEM_WORDS.format(id="doc_id", table="documents")}), bw AS ({ITEM_WORDS.format(id="item_id", table="benchmark")}),
    b AS ({RUNS.format(id="item_id", words="bw")}),
    d AS ({RUNS.format(id="doc_id", words="(SELECT doc_id, w, z.k FROM dw JOIN (SELECT DISTINCT k FROM bw) AS z ON z.k <= len(w))")}),
    n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id),
    j AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (k, s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_shingles, n_shared, CAST(n_shared AS DOUBLE) / n_shingles AS containment
    FROM j JOIN n USING (item_id) WHERE CAST(n_shared AS DOUBLE) / n_shingles >= CAST(0.8 AS DOUBLE)"""


def op8_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(read(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Expected grade and tail probabilities of every document, learned from three quarters of the labels.

    Grades: 0 for low quality, 1 for good quality but toxic, 2 for good quality. Documents are kept
    that are likelier of grade 1 or better than not.
    """
    docs = read(spark, sf, "documents").select("doc_id", "text")
    rated = read(spark, sf, "labels").where(~held_out()).withColumn("grade", F.expr("quality * (2 - coalesce(toxic, 0))"))
    found = quality.grade(docs, quality.learn(docs, rated)).withColumn("held_out", held_out())
    first, second = (F.coalesce(F.get("tails", k), F.lit(1.0)) for k in (F.lit(0), F.lit(1)))
    return found.select("doc_id", "held_out", "expected_grade", first.alias("p_at_least_1"), second.alias("p_at_least_2"),
                        (first >= 0.5).alias("kept"))


#: The texts of the two turns of conversation -1: control strings that must come back as they were.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the written output."""
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    folder = shared_path(spark, "chat")
    chat.format_conversations(turns.union(control)).write.parquet(folder)
    return chat.digests(spark.read.parquet(folder))


#: Parameters: the texts of conversation -1. Loss and turns follow from the table itself; the formatted
#: length counts 24 template characters per turn, the role, the text, and one for each escape.
OP10_SQL = f"""
    WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
    e AS (SELECT *, replace(text, chr(92), chr(92) || chr(92)) AS doubled FROM t),
    c AS (SELECT *, len(regexp_extract_all(doubled, '(<[|]im_start[|]>|<[|]im_end[|]>|<[|]endoftext[|]>|<s>|</s>|<unk>|<<SYS>>|<</SYS>>|[[]INST[]]|[[]/INST[]])'))
                 AS n_control FROM e)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(24 + length(role) + length(doubled) + n_control) AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id"""


def op11_cross_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links of two tokenizers' ids in every document, weighed by counts over all documents."""
    found = alignment.align(read(spark, sf, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of every document: known forms, and runs that the models find likelier drawn at random."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.learn(secret_scan.labelled_strings(docs)))
    spans, listed = F.col("spans"), secret_scan.listed
    return found.select("doc_id", *(secret_scan.count_of(spans, k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]),
                        F.sha2(listed(F.filter(spans, lambda s: s["kind"] != secret_scan.KINDS[3])).cast("binary"), 256).alias("base_sha256"),
                        listed(spans).alias("spans"), secret_scan.count_of(spans, secret_scan.KINDS[3]).alias("n_random"))


#: Conversations of one block of so many ids begin with up to five turns of the block's first one.
BLOCK_IDS, MOST_BORROWED = 100, 6


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of every conversation behind the first h of its block's first conversation, h by its id; all ids.

    Blocks are 100 ids from a multiple of 100 on, below zero too: -7 belongs to the block of -100.
    """
    own = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    given = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    numbered = materialize(given.select("conv_id", (F.row_number().over(own) - 1).alias("turn"), "role", "text"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED
    kept = numbered.where(F.col("turn") >= h)
    # null, which joins nothing, where the block would begin below the smallest bigint
    first = F.try_subtract("conv_id", F.pmod("conv_id", F.lit(BLOCK_IDS)))
    ids = numbered.where("turn = 0").select("conv_id")
    wanted = ids.select(F.col("conv_id").alias("_own"), first.alias("conv_id"), h.alias("_h"))
    lent = numbered.where((F.col("turn") < MOST_BORROWED - 1) & (F.col("conv_id") % BLOCK_IDS == 0))
    borrowed = lent.join(wanted, "conv_id").where("turn < _h").select(F.col("_own").alias("conv_id"), "turn", "role", "text")
    return kept.unionByName(borrowed), ids


def op13_conversation_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    turns, ids = rebuilt_conversations(read(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))
    return prefix_trie.prefix_nodes(materialize(turns), ids)


#: CRC-32 of a string's bytes, bit by bit.
CRC32_SQL = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, unused: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"""
OP13_SQL = f"""
    WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
               FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, {CRC32_SQL} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
    s AS (SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND p < h
          UNION ALL SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p >= h),
    q AS (SELECT c.conv_id, coalesce(list([role, text] ORDER BY p) FILTER (p IS NOT NULL), []) AS path FROM c LEFT JOIN s ON s.conv_id = c.conv_id GROUP BY c.conv_id),
    m AS (SELECT conv_id, d, path[1:d] AS node, len(path) = d AS at_end FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM q)),
    n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(length(node[-1][2]), 0) AS size,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256 FROM m GROUP BY node, d),
    k AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.d = k.d AND n.node = k.node),
    u AS (SELECT a AS d, node[1:a] AS node, sum((n_convs - 1) * size) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
          FROM (SELECT *, unnest(range(d + 1)) AS a FROM f) GROUP BY 1, 2)
    SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, f.ends_sha256
    FROM f JOIN u ON u.d = f.d AND u.node = f.node LEFT JOIN n AS o ON f.d > 0 AND o.d = f.d - 1 AND o.node = f.node[1:f.d - 1]"""


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_substring_dedup": (op1_substring_dedup, None),
    "op2_best_fit_packing": (op2_best_fit_packing, None),
    "op3_token_files": (op3_token_files, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_suffix_dedup": (op5_suffix_dedup, None),
    "op6_embedding_near_dedup": (op6_embedding_near_dedup, None),
    "op7_benchmark_decontamination": (op7_benchmark_decontamination, OP7_SQL),
    "op8_simhash_near_dedup": (op8_simhash_near_dedup, None),
    "op9_quality_classifier": (op9_quality_classifier, None),
    "op10_chat_formatting": (op10_chat_formatting, OP10_SQL),
    "op11_cross_tokenizer_alignment": (op11_cross_tokenizer_alignment, None),
    "op12_secret_scan": (op12_secret_scan, None),
    "op13_conversation_prefix_trie": (op13_conversation_prefix_trie, OP13_SQL),
}
