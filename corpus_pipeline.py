"""The training-data pipeline over ``documents``: language, near duplicates, benchmark leaks, personal data, packing.

Every stage takes what the one before it kept, written as Parquet and read again, and returns rows with the columns of
``documents``; the last returns where each piece of each text is packed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.llm import decontamination, jaccard, language, packing, pseudonyms
from lossledger.sources.tables import drop_table, read_table, save_table, work_folder, work_tables


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those without a letter and those unlike any learned language go."""
    return language.identify(docs).where(~F.col("rejected")).select(*docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each class of near duplicates."""
    return jaccard.first_of_each_class(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontamination.with_leaks(docs, read_table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(*docs.columns)


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in them replaced by pseudonyms of the same format (and length), with the session's key."""
    return pseudonyms.with_pseudonyms(docs, pseudonyms.configured_key(spark)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each_class),
    ("benchmark leaks", without_leaks),
    ("pseudonyms", pseudonymous),
    ("packing", packed),
]

#: Language models, sampled paths, alignments, keyed permutations and token ids are beyond SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage writes on the way goes once its own result is written, and that goes
    once the next stage's is; the last stage's tables stay for the reader of the result."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        kept = f"{work_folder(spark)}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        with work_tables(spark):
            docs = save_table(stage(spark, docs, sf_dir), kept)
        if before:
            drop_table(spark, before)
        before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
