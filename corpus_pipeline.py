"""Corpus pipeline over ``documents``: five of the training-data operators in sequence.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet below the shared checkpoint folder and reads them back as the
next stage's input.  All stages but the last return the columns they were given; the
last adds the shard of each row.  Nulls, empty texts, repeated rows and empty tables
are handled as the operators' docstrings state: stage 1 scores every row, stage 2
keeps a null doc_id and all rows of a kept doc_id's text, stage 3 drops rows by
(doc_id, text), stage 4 repeats or leaves out rows by its targets, stage 5 keeps all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filingfold.llm.common import staged, table
from filingfold.llm.decontaminate import decontaminate
from filingfold.llm.minhash import keep_one_of_each
from filingfold.llm.mixing import mix
from filingfold.llm.quality import keep_good
from filingfold.llm.sharding import assign


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return assign(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Trained models and signatures are not SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
