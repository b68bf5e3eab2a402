"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.alignment import alignment_report
from tallybook.llm.decontaminate import contaminated_pairs
from tallybook.llm.html_blocks import extract_main_text
from tallybook.llm.language_id import language_report
from tallybook.llm.packing import pack_texts
from tallybook.llm.quality_rules import quality_report
from tallybook.llm.simhash import near_duplicates
from tallybook.llm.spotsigs import spot_report
from tallybook.llm.token_counts import token_report
from tallybook.llm.token_files import token_file_report
from tallybook.llm.url_filter import judge_urls
from tallybook.llm.warc import archive_report
from tallybook.llm.whitening import whitening_report

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_report(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_file_report(documents, public_tokenizers.path("word_bpe_49k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated_pairs(documents, table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def op11_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_html_blocks": op2_html_blocks,
        "op3_language_id": op3_language_id,
        "op4_token_counts": op4_token_counts,
        "op5_token_files": op5_token_files,
        "op6_simhash": op6_simhash,
        "op7_warc": op7_warc,
        "op8_decontamination": op8_decontamination,
        "op9_packing": op9_packing,
        "op10_url_filter": op10_url_filter,
        "op11_spotsigs": op11_spotsigs,
        "op12_whitening": op12_whitening,
        "op13_alignment": op13_alignment,
    }


#: SHA-1 in base32: five bits of the digest a letter.
OP7_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT hex, unhex(hex)::BIT::VARCHAR AS b FROM (SELECT DISTINCT hex FROM p)
), digests AS (
  SELECT hex, list_aggregate(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + 16 * substr(b, i * 5 + 1, 1)::INT + 8 * substr(b, i * 5 + 2, 1)::INT
       + 4 * substr(b, i * 5 + 3, 1)::INT + 2 * substr(b, i * 5 + 4, 1)::INT
       + substr(b, i * 5 + 5, 1)::INT)::BIGINT, 1)), 'string_agg', '') AS payload_digest
  FROM bits
), first AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN digests USING (hex) JOIN first USING (hex)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_warc": OP7_SQL}
