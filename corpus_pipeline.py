"""Corpus pipeline over ``documents``; its stages call the operators of ``daybook.llm``.

``STAGES`` lists (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontamination, packing, simhash, suffix_array
from daybook.llm import toxicity as toxicity_model
from daybook.llm.common import documents, materialize
from daybook.llm.tokens import tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the factorization machine, fitted on ``labels``, calls toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity_model.drop_toxic(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group (3-word shingles, 2 bits): the least id."""
    return simhash.keep_one(docs, n=3, max_bits=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out strings of 50 bytes that a document with a smaller id has too."""
    return suffix_array.without_repeats(docs, min_bytes=50)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover at least half of a benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Hierarchical packing of what is left, one row for each piece."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("simhash", near_duplicates),
          ("suffix-array", repeated_passages), ("decontamination", benchmark_leaks),
          ("packing", pack)]

# Learned weights, suffix structures and tokenisers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each but the last written and read again."""
    df = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        df = materialize(stage(spark, df, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, df, sf_dir)
