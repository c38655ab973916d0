"""From documents to packed token rows: language ID, near-dedup, benchmark
decontamination, source mixing and packing, each by an operator of
``claimflow.llm``. Every stage reads what the one before it wrote, judges rows
one by one whatever their keys, carries all columns along, and takes an empty
table to an empty one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimflow.llm import decontaminate, language_id, mixing, near_dedup, packing
from claimflow.llm.common import read, stage_table


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network names with a probability of 0.5 or
    more; it learns from the languages given with the documents. Null texts and
    texts without a letter have no language and go; null languages are not
    learned; repeated rows stay or go alike."""
    return language_id.known_language_documents(docs, language_id.fit(docs))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8 or more), of
    exact copies too. Rows that share a key but not their text are different
    documents; rows with a null key, and rows without a word, stay."""
    return near_dedup.unique_documents(docs, shingle_words=5, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item, nor a
    shorter item whole. Null and empty texts stay; null items match nothing."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; texts cut to the words taken. A
    null source is a source; null and empty texts have no words to take; repeated
    rows count as often as they occur."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in rows of fixed length. Null and empty texts have no tokens;
    repeated rows are packed each."""
    return packing.pack_documents(docs)


STAGES = [("language_id", known_languages), ("near_dedup", unique), ("decontaminate", uncontaminated), ("mixing", mixed), ("packing", packed)]

#: A trained network, permutations and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
