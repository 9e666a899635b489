"""From raw documents to packed training sequences, one written table after the other.

Defined cases, in all stages: a null text counts as empty, is clean in every sense and stays (packed as the closing id
alone); texts are read whole, however long; of near copies the one of the least id stays, ties of nothing else; rows that
share an id stay or go together; repeated rows are one node of a group and stay together; an empty table gives an
empty one; a document with a null id is in no group and stays; all columns but the text pass through untouched, whatever
their names, up to the last stage, which returns places only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import drop_written, table, written
from millrace.llm.decontamination import decontaminated
from millrace.llm.near_dedup import one_of_each
from millrace.llm.packing import packed
from millrace.llm.pseudonyms import with_pseudonyms
from millrace.llm.toxicity import not_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    return not_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values under pseudonyms."""
    return with_pseudonyms(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: SQL can't express the learned, hashed and tokenised stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, written(stage(spark, docs, sf_dir), name)
        drop_written(last)
    return STAGES[-1][1](spark, docs, sf_dir)
