"""The corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. The first three give documents in the columns of the documents table:
quality rules remove failing lines and failing documents, the classifier
removes documents unlikely to have the best grade, near-dedup keeps the
smallest doc_id of each group of copies, which are linked by fingerprints
within two bits or by five-word shingles with a similarity of 0.8 or more. The
last packs what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import copies, ordinal, packing, quality_rules, queries
from tessera.llm.common import persist_table, table


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean_documents(docs)


def apply_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from all documents, so that it has seen what the rules remove."""
    model = ordinal.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return ordinal.select_documents(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash's components and exact near copies in one pass over the texts."""
    return copies.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, queries.BYTE_BPE, queries.SEQUENCE, end_id=0)


STAGES = [
    ("quality rules", apply_quality_rules),
    ("quality classifier", apply_classifier),
    ("simhash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack),
]

#: The classifier's and the tokenizer's results can't be written in SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = persist_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
