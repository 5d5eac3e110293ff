"""A table of the Bronze files that were taken in: (process_date, path, length, modified).

Files are listed by Spark (the folders of many dates by its executors), and what a run took in
is kept by arrival date. The Bronze gate, the sizes behind shuffle partitions, and the search
for late files read this table; a date's *fingerprint*, a hash over its files, names in the
commits of the layers what their rows were made from.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schema import BRONZE_PARTITION
from daybook.sources import fs, layers

INDEX_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), True),  # below the Bronze root
    T.StructField("length", T.LongType(), True),
    T.StructField("modified", T.TimestampType(), True),
])
_FILES = T.StructType([T.StructField("process_date", T.DateType(), True), *INDEX_SCHEMA.fields])


@dataclass(frozen=True)
class Delivered:
    """What a date has: number of files, bytes, and the hash over them."""

    files: int
    bytes: int
    fingerprint: str


def list_files(spark: SparkSession, bronze_root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """The files that lie in the date folders now; contents are not read.

    Names that start with ``_`` or ``.`` and files of no bytes are not data. A date without a
    folder has no rows.
    """
    root, asked = bronze_root.rstrip("/"), None if dates is None else set(dates)
    names = [n for n in fs.subdirs(spark, root) if n.startswith(f"{BRONZE_PARTITION}=")]
    names = [n for n in names if asked is None or n.partition("=")[2] in asked]
    if not names:
        return spark.createDataFrame([], _FILES)
    path = F.regexp_extract("path", f"({BRONZE_PARTITION}=[^/]+/.*)$", 1)
    return (spark.read.format("binaryFile").load([f"{root}/{n}" for n in names])
            .select(F.to_date(F.regexp_extract("path", f"{BRONZE_PARTITION}=([^/]+)/", 1)).alias("process_date"),
                    path.alias("path"), "length", F.col("modificationTime").alias("modified")))


def fingerprints(files: DataFrame) -> DataFrame:
    """(process_date, files, bytes, fingerprint), a row for each date."""
    one = F.xxhash64("path", "length", F.unix_micros("modified")).cast("decimal(38,0)")
    return files.groupBy("process_date").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"),
        F.sum(one).cast("string").alias("fingerprint"))


def delivered(files: DataFrame) -> dict[str, Delivered]:
    """The fingerprints on the driver: one row for each date."""
    return {r["process_date"].isoformat(): Delivered(r["files"], r["bytes"], r["fingerprint"])
            for r in fingerprints(files).collect()}


def remember(spark: SparkSession, files: DataFrame, index_root: str, made_from: dict[str, str]) -> None:
    """Keep ``files`` as what the dates (with their fingerprints) were made from."""
    layers.replace_dates(spark, files.hint("rebalance", "process_date"), index_root, list(made_from),
                         made_from=made_from)


def known_files(spark: SparkSession, index_root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """The files that were taken in."""
    return layers.read_layer(spark, index_root, INDEX_SCHEMA, dates)


def late_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """(process_date, path, length, modified, changed) of files that came or changed since.

    ``changed`` is true for a known file of another length or time, and for one that is gone
    (its length is null): the rows it gave are not known, so its date has to be run anew.
    """
    old = known.select("process_date", "path", F.struct("length", "modified").alias("_old"))
    both = listed.withColumn("_new", F.struct("length", "modified")).join(
        old, ["process_date", "path"], "full")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        "process_date", "path", "length", "modified", F.col("_old").isNotNull().alias("changed"))


def present(index: DataFrame, first: str, last: str) -> DataFrame:
    """(process_date, present) of every day from ``first`` to ``last``: a join with the index."""
    days = index.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("process_date"))
    held = index.groupBy("process_date").agg(F.count("*").alias("files"))
    return days.join(held, "process_date", "left").select(
        "process_date", F.col("files").isNotNull().alias("present"))
