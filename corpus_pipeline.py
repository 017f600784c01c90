"""The corpus pipeline. Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchside.llm.mixing import mixed_documents
from pitchside.llm.packing import pack_documents
from pitchside.llm.quality import fit, with_scores
from pitchside.llm.queries import KEEP_FROM, learnt, table, tokenizer_path
from pitchside.llm.rules import cleaned
from pitchside.llm.shared import materialise
from pitchside.llm.simhash import one_of_each


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores below the threshold go."""
    return with_scores(docs, fit(docs, table(spark, sf_dir, "labels"), learnt()), KEEP_FROM, None)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines leave the texts; documents that fail the rules or are depleted go."""
    return cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it, which may be never."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of the packed sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # compression, fingerprints and subword ids have no SQL form; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, name.replace(" ", "-"))
    return docs
