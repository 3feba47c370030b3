"""The registered queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import work_path

from . import conversations, language_id, toxicity
from .audit_sql import AUDIT_SQL, REPAIR_SQL
from .automaton import encode_texts
from .common import remainder, table
from .decontamination import find_leaks
from .filter_audit import audit_filters
from .huffman import read_token_files, write_token_files
from .mtree import quantize, top_k
from .packing import pack
from .recompression import remove_repeats
from .simhash import near_duplicates
from .suffix_dedup import remove_repeated_bytes
from .token_counts import count_tokens
from .tokenizing import public_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learned from four fifths of the labels."""
    docs = table(spark, folder, "documents")
    machine = toxicity.learn(docs, table(spark, folder, "labels"), remainder("doc_id", 5) != 0)
    return toxicity.score_toxicity(docs, machine).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text."""
    counted = count_tokens(table(spark, folder, "documents"), public_path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector with all others."""
    vectors = quantize(table(spark, folder, "embeddings"), scale=64)
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose fingerprints differ in at most 3 bits."""
    return near_duplicates(table(spark, folder, "documents"), shingle=3, budget=3)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learned from three quarters of the documents."""
    docs = table(spark, folder, "documents")
    model = language_id.learn(docs, remainder("doc_id", 4) != 2)
    return language_id.identify(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of all documents without those in strings of 400 bytes that start elsewhere too."""
    found = remove_repeated_bytes(table(spark, folder, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files and read back."""
    path = work_path(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), path, public_path("word_bpe_49k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of ten words of the benchmark, found in all documents."""
    found = find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(
        table(spark, folder, "documents"), public_path("byte_bpe_50k.json"), keep={"ids_crc32": F.crc32("ids")}
    )


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents without those in windows of 20 that start earlier elsewhere."""
    found = remove_repeats(table(spark, folder, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by the tokenization automaton, and decoded again."""
    found = encode_texts(table(spark, folder, "documents"), public_path("word_bpe_49k.json"), decode=True)
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged conversations and the cheapest edits that repair them."""
    rows = conversations.damaged(table(spark, folder, "conversations"))
    return conversations.repair(rows, gone=rows["dropped"])


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove in every order of application."""
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_topk_search": op3_topk_search,
    "op4_simhash": op4_simhash,
    "op5_language_id": op5_language_id,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_bpe": op11_bpe,
    "op12_conversations": op12_conversations,
    "op13_filter_audit": op13_filter_audit,
}
#: The others rest on tokenizers, learned models or hashes that DuckDB lacks; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op12_conversations": REPAIR_SQL,
    "op13_filter_audit": AUDIT_SQL,
    "op3_topk_search": """
WITH parts AS (
    SELECT vec_id, embedding, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
    FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
), vectors AS (
    SELECT vec_id, list(CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) ORDER BY i) AS q
    FROM parts GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""",
    "op8_decontamination": r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS words
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
          FROM (SELECT *, least(10, len(w)) AS n FROM item_words WHERE len(w) > 0))
), doc_windows AS (
    SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
          FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
    SELECT d.doc_id, d.k, d.n, i.item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.words = i.words
), words_hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS word FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op10_substring_dedup": r"""
WITH texts AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), starts AS (
    SELECT doc_id, k, md5(array_to_string(w[k : k + 19], ' ')) AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM texts WHERE len(w) >= 20)
), repeats AS (
    SELECT doc_id, k, row_number() OVER (PARTITION BY words ORDER BY doc_id, k) > 1 AS again FROM starts
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM texts
), judged AS (
    SELECT doc_id, word, k, coalesce(bool_or(again) OVER (
        PARTITION BY doc_id ORDER BY k ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), FALSE) AS gone
    FROM words LEFT JOIN repeats USING (doc_id, k)
), kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
           string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS text
    FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
""",
}
