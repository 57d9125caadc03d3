"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: a
    lineage cut that survives lost executors and keeps column pruning and pushdown."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  A text without multi-byte characters takes the plain
    ``lower``; elsewhere ``translate`` leaves accented capitals alone."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_fold(modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``: the fold of a document.  A null doc_id
    counts as the empty text."""
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")
