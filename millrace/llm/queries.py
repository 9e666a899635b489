"""The operators over their whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import table
from .conversation_trie import trie_report
from .decontamination import decontamination_report
from .fill_in_middle import fill_in_middle_report
from .fingerprints import fingerprint_report
from .licenses import license_blocks
from .lm_scoring import lm_scores
from .near_dedup import near_duplicates
from .packing import packed
from .pieces import piece_report
from .pseudonyms import pseudonym_report
from .token_counts import token_counts
from .tool_calls import conversation_calls
from .toxicity import toxicity_report


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_blocks(table(spark, sf_dir, "documents"))


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonym_report(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = conversation_calls(table(spark, sf_dir, "conversations"))
    return out.withColumn("problems", F.array_join("problems", ","))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_report(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_report(table(spark, sf_dir, "conversations"))


def op13_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_near_dedup": op2_near_dedup,
    "op3_license_scans": op3_license_scans,
    "op6_pii_pseudonyms": op6_pii_pseudonyms,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_toxicity": op5_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_decontamination": op9_decontamination,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_piece_encoding": op13_piece_encoding,
}

ORACLE_SQL: dict[str, str] = {
    "op2_near_dedup": oracles.NEAR_DEDUP,
    "op4_chat_formatting": oracles.CHAT_FORMATTING,
    "op9_decontamination": oracles.DECONTAMINATION,
    "op11_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op12_conversation_trie": oracles.CONVERSATION_TRIE,
}
