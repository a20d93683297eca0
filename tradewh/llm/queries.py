"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewh.llm import (arrow_files, conversations, lattice_lm, licenses, packing, permutation_index, personal, pieces, quality,
                         simhash, spelling, toxicity, warc)
from tradewh.llm.common import in_fold, table
from tradewh.operators.materialize import materialize


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, toxicity.training_rows(table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op7_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_files.read_documents(arrow_files.write(table(spark, sf_dir, "documents")))


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lattice_lm.score_documents(table(spark, sf_dir, "documents"), ~in_fold("doc_id", 7, 2), rounds=2)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         F.col("score_mixed").alias("score"), F.col("score").alias("score_lattice"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_records(warc.write(table(spark, sf_dir, "pages")), with_payload=False)
    return warc.page_digest(warc.assemble(materialize(records, "warc-records")))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal.digest(personal.find_personal(docs, personal.fit_personal(docs)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_permutation_index": op6_permutation_index,
    "op7_arrow_sequences": op7_arrow_sequences,
    "op8_lattice_lm": op8_lattice_lm,
    "op9_warc": op9_warc,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_personal_data": op12_personal_data,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    "op9_warc": """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest
    FROM pages
), latest AS (
    SELECT digest, n, max(page_id) AS top FROM payloads WHERE n >= 1000 GROUP BY digest, n
)
SELECT p.page_id, p.n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN l.top <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN l.top <> p.page_id THEN l.top END AS refers_to
FROM payloads p LEFT JOIN latest l ON p.digest = l.digest AND p.n = l.n
""",
}
