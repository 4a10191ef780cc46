"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    conversations, dedup, extraction, fingerprints, minhash, packing, pieces, simhash, token_counts, token_files, toxicity, warc, whitening,
)
from strata.llm.common import table
from strata.session import scratch_path


def revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicate(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def token_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.cached_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "token-cache")
    )


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, path)
    return token_files.read_token_files(spark, path)


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisit_resolution": revisit_resolution,
    "op2_simhash_near_dedup": simhash_near_dedup,
    "op3_token_counts": token_counting,
    "op4_document_fingerprints": document_fingerprints,
    "op5_token_id_files": token_id_files,
    "op6_html_extraction": html_extraction,
    "op7_toxicity": toxicity_scores,
    "op8_piece_round_trip": piece_round_trip,
    "op9_exact_dedup": exact_dedup,
    "op10_best_fit_packing": best_fit_packing,
    "op11_embedding_whitening": embedding_whitening,
    "op12_conversation_repair": conversation_repair,
    "op13_minhash_near_dedup": minhash_near_dedup,
}

ORACLES: dict[str, str] = {
    "op1_revisit_resolution": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        q AS (SELECT page_id, strlen(h)::BIGINT AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS original FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < original THEN original END AS refers_to
        FROM q""",
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        g AS (SELECT norm, arg_min(doc_id, (-chars, doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)""",
}
