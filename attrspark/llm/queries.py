"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from attrspark.llm.conversation_trie import conversation_trie
from attrspark.llm.decontaminate import contaminated
from attrspark.llm.html_text import main_texts
from attrspark.llm.kneser_ney import is_held_out, toxicity
from attrspark.llm.licenses import license_matches, notices
from attrspark.llm.minhash import near_duplicates
from attrspark.llm.oracles import codes_sql, trie_sql
from attrspark.llm.packing import packed_documents
from attrspark.llm.simhash import edited_fingerprints
from attrspark.llm.suffix_tree import scored
from attrspark.llm.token_counts import token_counts
from attrspark.llm.token_files import token_file_rows
from attrspark.llm.vector_codes import vector_codes
from attrspark.llm.warc import archived_pages

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(table(spark, folder, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=2, percent=80)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(spark, table(spark, folder, "documents"), TOKENIZER)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    rows = archived_pages(spark, table(spark, folder, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(spark, folder, "documents"))


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return scored(docs.withColumn("held_out", is_held_out("doc_id", 7, 2)))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_rows(spark, table(spark, folder, "documents"), TOKENIZER)


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return license_matches(table(spark, folder, "documents"), notices(spark))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), PIECES)


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(table(spark, folder, "embeddings")).drop("label")


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_warc": op5_warc,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_files": op8_token_files,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_license_scans": op10_license_scans,
    "op11_token_counts": op11_token_counts,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op12_vector_codes": codes_sql(),
    "op13_conversation_trie": trie_sql(),
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, sha256(h) AS digest, strlen(h) AS n, min(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
          CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM d
    """,
    "op2_minhash_near_dedup": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
          SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 1 THEN w
            ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM words
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
          FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
        ), links AS (
          SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
          WHERE 100 * k >= 80 * (p.n + q.n - k)
        ), reached AS (
          SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        ), smallest AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
}
