"""Pick up newly landed Bronze files and bring their arrival dates up to date.

The reference runs its pipeline once a day for the date that just landed. Here a
file stream over the Bronze folder notices new files (only their paths: the
``binaryFile`` source with ``content`` pruned reads no data), and every
micro-batch takes in the new files of the arrival dates that received some: a date that
was run before gets the parts of those files merged into its Gold, a new one is run. The
stream's checkpoint records which files triggered work, and the table of files taken in makes
a retried batch harmless. With
``availableNow`` the query processes everything that has landed and stops,
which is the daily job; with a processing-time trigger it keeps running.

Costs to keep in mind at scale: the file source lists the folder on every
trigger (``max_file_age`` bounds which files count as new, not the listing), and
every batch adds a folder to the tables of each date it touches. A run of the date
(``run_dates``) brings them back to one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daybook.plans import pipeline
from daybook.session import configure

FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])
DATE_IN_PATH = r"date=(\d{4}-\d{2}-\d{2})"


def landed_dates(spark: SparkSession, bronze_root: str,
                 max_file_age: str | None = None) -> DataFrame:
    """A stream of (process_date) for every newly landed Bronze file."""
    reader = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    files = reader.load(bronze_root)
    return files.select(F.regexp_extract("path", DATE_IN_PATH, 1).alias("process_date")) \
        .where(F.col("process_date") != "")


def _run_batch(paths: pipeline.Paths, load: bool):
    def run(batch: DataFrame, epoch_id: int) -> None:
        # One row per landed date: bounded by the dates in this batch, not by rows.
        dates = sorted(r[0] for r in batch.distinct().collect())
        if not dates:
            return
        spark = batch.sparkSession
        pipeline.apply_late_files(spark, paths, dates)
        if load:  # all dates of the batch: one that is done again may have stopped before the load
            pipeline.load(spark, paths, dates)
    return run


def default_checkpoint(spark: SparkSession, paths: pipeline.Paths) -> str:
    """A stable checkpoint folder for the ingest of one Bronze folder, beside the mart.

    It belongs to the lake: it must outlive the session and be seen by the next one.
    """
    key = hashlib.sha1(paths.bronze.rstrip("/").encode()).hexdigest()[:16]
    return f"{paths.mart.rstrip('/')}-ingest-{key}"


def start(spark: SparkSession, paths: pipeline.Paths, checkpoint: str | None = None,
          available_now: bool = True, load: bool = True, interval: str = "1 minute",
          max_file_age: str | None = None) -> StreamingQuery:
    """Start the ingest.

    The checkpoint records which files were handled, so it must stay the same
    across runs; by default it is a folder beside the mart named after the Bronze folder.
    """
    configure(spark)
    checkpoint = checkpoint or default_checkpoint(spark, paths)
    writer = (landed_dates(spark, paths.bronze, max_file_age).writeStream
              .foreachBatch(_run_batch(paths, load))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=interval)
    return writer.start()
