"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the stage before has kept, and all but the last return the columns of
``documents``. Between stages the rows are written and read again, so a lost executor costs
one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crmweave.llm import decontaminate, exact_dedup, packing, quality, simhash
from crmweave.llm.common import table
from crmweave.session import write_table

VOCABULARY, SEQUENCE, END = "word_bpe_49k.json", 4096, 1
SHINGLE, RADIUS = 4, 4


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on these documents' labels, lets pass.

    A null text counts as empty; repeated rows are judged alike.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that are equal without white space: the longest as written.

    Null and empty texts are one group; of repeated rows one stays.
    """
    return exact_dedup.keep_unique(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies: fingerprints of four words, at most four bits apart.

    Null and empty texts are one group; of repeated rows one stays.
    """
    return simhash.keep_one_of_each(docs, SHINGLE, RADIUS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is like a benchmark item by 0.8 or more.

    Null and empty texts hold none and stay; repeated rows are judged alike.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences.

    A null text counts as empty, which is one end token; repeated rows are packed each.
    """
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), SEQUENCE, END)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

# A classifier, fingerprints and a tokenizer have no SQL; tests hold every stage against
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
