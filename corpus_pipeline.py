"""From documents to packed training sequences: four stages over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from deskmatch.llm import near, packing, rules, toxicity
from deskmatch.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base conditions and the decision list learnt from the labels."""
    return rules.keep_good(docs, rules.quality_rules(docs, table(spark, sf_dir, "labels")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.learn_model(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more."""
    return near.keep_one(docs, size=5, percent=80)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("quality rules", quality_rules), ("toxicity", toxicity_filter), ("MinHash near-dedup", near_dedup),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage keeps is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express learning, banding and packing; tests hold the stages against plain versions
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
