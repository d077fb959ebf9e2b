"""Queries of the corpus operators, by name, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard_join, licenses, line_templates, merkle, repair, surrogates
from .common import table
from .decontaminate import contaminated
from .hilbert_search import nearest
from .packing import pack
from .quality import score_quality
from .secret_scan import scan_secrets
from .toxicity import score_toxicity


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"))


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs, dropped_col="n_dropped", exact=True)


def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_conversations(table(spark, sf_dir, "conversations"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_personal_data(docs, count_col="n_entities")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair_conversations(repair.damaged(conversations), conversations)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_line_templates": op2_line_templates,
    "op3_chat_snapshots": op3_chat_snapshots,
    "op4_surrogates": op4_surrogates,
    "op5_toxicity": op5_toxicity,
    "op6_hilbert_neighbours": op6_hilbert_neighbours,
    "op7_secret_scan": op7_secret_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_license_scan": op11_license_scan,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op2_line_templates": line_templates.SQL,
    "op3_chat_snapshots": chat.SQL,
    "op8_jaccard_join": jaccard_join.SQL,
    "op11_license_scan": licenses.SQL,
    "op12_conversation_repair": repair.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
