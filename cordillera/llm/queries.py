"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_round_trip
from .common import table
from .embedding_dedup import embedding_links
from .exact_dedup import exact_groups
from .jaccard_join import jaccard_components
from .line_dedup import line_report
from .packing import pack_documents
from .quality import score_quality
from .substring_dedup import substring_report
from .toxicity import score_toxicity
from .warc import warc_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_bpe,
        op3_toxicity,
        op4_quality,
        op5_line_dedup,
        op6_exact_dedup,
        op7_warc,
        op8_jaccard_join,
        op9_embedding_dedup,
        op10_packing,
    )
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": rf"""
        WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
        win AS (
            SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
        ),
        low AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
        hit AS (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM win JOIN low USING (h) WHERE d < doc_id),
        gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM hit GROUP BY doc_id),
        kept AS (
            SELECT doc_id, ws,
                   CASE WHEN ks IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ks, i)) END AS left_over
            FROM w LEFT JOIN gone USING (doc_id)
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(left_over))::BIGINT AS n_removed,
               sha256(array_to_string(left_over, ' ')) AS kept_sha256
        FROM kept""",
    "op5_line_dedup": r"""
        WITH l AS (SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS ls FROM documents),
        win AS (
            SELECT doc_id, i, sha256(array_to_string(ls[i:i + 2], chr(10))) AS h
            FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM l WHERE len(ls) >= 3)
        ),
        nth AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM win),
        gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(i, i + 3)) AS k FROM nth WHERE n > 1) GROUP BY doc_id),
        kept AS (
            SELECT doc_id, ls,
                   CASE WHEN ks IS NULL THEN ls ELSE list_filter(ls, lambda x, i: NOT list_contains(ks, i)) END AS left_over
            FROM l LEFT JOIN gone USING (doc_id)
        )
        SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - len(left_over))::BIGINT AS n_removed,
               sha256(array_to_string(left_over, chr(10))) AS kept_sha256
        FROM kept""",
    "op6_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM n""",
    # 40 hexadecimal digits are 8 groups of 20 bits, each 4 digits of base 32.
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (((('0x' || substr(h, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM d""",
}
