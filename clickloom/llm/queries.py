"""One query per text operator, over whole tables with production parameters, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    chat, classifier, codes, fingerprints, jaccard, licenses, lm, merkle, mixing, packing, rules, tokens,
    two_fit,
)
from clickloom.llm.oracle import ORACLE  # noqa: F401
from clickloom.llm.text import table


def op1_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    placed = mixing.schedule(table(spark, folder, "documents").select("doc_id", "source"))
    return placed.select(
        F.col("row.doc_id").alias("doc_id"), "source", "block", "release", "deadline", "slot", "place"
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"))


def op3_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repaired(table(spark, folder, "conversations"))


def op4_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = lm.backoff_scores(table(spark, folder, "documents"))
    rounded = {c: F.round(c, 4) for c in ("log_score", "mean_log_score")}  # sums of doubles
    return scores.withColumns(rounded)


def op5_license_spans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_spans(table(spark, folder, "documents"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return rules.quality_rules(documents, rules.fit_rules(documents, table(spark, folder, "labels")))


def op7_jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


def op8_bfd_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op9_oph_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_pairs(table(spark, folder, "documents"))


def op10_subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = classifier.fit_quality(documents, table(spark, folder, "labels"))
    return classifier.score_quality(documents, model)


def op11_two_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return two_fit.pack_two_fit(table(spark, folder, "documents"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.merkle_proofs(table(spark, folder, "documents"))


def op13_ball_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.product_codes(table(spark, folder, "embeddings"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_pfair_mix, op2_token_counts, op3_chat_repair, op4_backoff_scores, op5_license_spans,
        op6_quality_rules, op7_jaccard_components, op8_bfd_packing, op9_oph_fingerprints,
        op10_subword_quality, op11_two_fit_packing, op12_merkle_manifest,
        op13_ball_codes,
    )
}
