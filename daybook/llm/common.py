"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_dir

# Rows handed to Python at a time: long texts make batches of the default 10,000 rows
# larger than a worker should hold.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def session_of(df: DataFrame) -> SparkSession:
    """The session of ``df``, set to hand texts to Python in small batches.

    Python workers of a local master find this package where the driver found it; a
    cluster gets it with the application.
    """
    spark = df.sparkSession
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns the operators read, so that no other column can clash.

    A null text counts as empty. Rows with a null or a repeated id stay.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Later steps then start from files that outlive any executor.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files behind ``df`` as Catalyst's statistics have them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString()))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of each batch as tuples, one row at a time."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def crc32_mod(column, modulus: int):
    """crc32 of a column's text, modulo ``modulus``; a null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % F.lit(modulus)


