"""Headers of the Bronze files: what each file's first line names, and reading by those names.

Executors open the files of the index and read one line each; file contents are not scanned.
Files are grouped by header, and each group is read with its own column order, so a file with
its columns in another order reads right, a missing column is NULL and a further one is left out.

The one-line reader uses Arrow's file systems (local, HDFS, S3, GCS); the rows are read by Spark.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schema import BRONZE_COLUMNS, BRONZE_PARTITION, BRONZE_SCHEMA
from daybook.sources import file_index, fs

# A header line is looked for in so many bytes of a file.
MOST_HEADER_BYTES = 1 << 16
_HEADERS = "process_date date, path string, header array<string>"


def first_line(path: str) -> str:
    """The first line of a text file, without its line end; compressed files by their suffix."""
    system, inner = pafs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    with system.open_input_stream(inner, compression="detect") as stream:
        data = stream.read(MOST_HEADER_BYTES)
    return data.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", "replace")


def read_headers(spark: SparkSession, bronze_root: str, files: DataFrame) -> DataFrame:
    """(process_date, path, header) of every file: the names its first line has.

    Files are dealt to tasks by path. (A file of no bytes is not listed at all.)
    """
    root = fs.qualified(spark, bronze_root.rstrip("/"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [first_line(f"{root}/{p}") for p in batch.column("path").to_pylist()]
            names = [next(csv.reader([line]), []) for line in lines]
            yield pa.RecordBatch.from_pydict({
                "process_date": batch.column("process_date"), "path": batch.column("path"),
                "header": pa.array(names, pa.list_(pa.string()))})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.select("process_date", "path").repartition(n, "path").mapInArrow(read, _HEADERS)


def header_report(headers: DataFrame) -> DataFrame:
    """(process_date, path, header, missing, extra, reordered, passed), a row for each file.

    ``missing`` and ``extra`` are column names against the declared ones; ``reordered`` says
    that the declared columns a file has stand in another order.
    """
    declared = F.array(*map(F.lit, BRONZE_COLUMNS))
    known = F.filter("header", lambda c: F.array_contains(declared, c))
    in_order = F.filter(declared, lambda c: F.array_contains(F.col("header"), c))
    return headers.select(
        "process_date", "path", "header", F.array_except(declared, "header").alias("missing"),
        F.array_except("header", declared).alias("extra"),
        (known != in_order).alias("reordered"), (F.col("header") == declared).alias("passed"))


def read_by_name(spark: SparkSession, bronze_root: str, dates=None) -> DataFrame:
    """Typed Bronze rows plus ``process_date``, columns bound by the names in each file's header.

    One scan for each different header; a name that a header has twice counts where it stands
    first. Malformed values become NULL as in ``read_bronze``.
    """
    listed = file_index.list_files(spark, bronze_root, dates)
    found = read_headers(spark, bronze_root, listed).where(F.size("header") > 0)
    groups = found.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    root = bronze_root.rstrip("/")
    kinds = {f.name: f.dataType for f in BRONZE_SCHEMA.fields}

    def read(header: list[str], paths: list[str]) -> DataFrame:
        fields, seen = [], set()
        for i, name in enumerate(header):
            own = name in kinds and name not in seen
            seen.add(name)
            fields.append(T.StructField(name if own else f"_other_{i}", kinds[name] if own else T.StringType()))
        schema = T.StructType([*fields, T.StructField(BRONZE_PARTITION, T.DateType())])
        rows = (spark.read.schema(schema).option("header", True).option("basePath", root)
                .csv([f"{root}/{p}" for p in paths]))
        return rows.select(*[F.col(c) if c in seen else F.lit(None).cast(kinds[c]).alias(c)
                             for c in BRONZE_COLUMNS], F.col(BRONZE_PARTITION).alias("process_date"))

    if not groups:
        return spark.createDataFrame([], T.StructType(
            [*BRONZE_SCHEMA.fields, T.StructField("process_date", T.DateType())]))
    return reduce(DataFrame.unionByName, [read(g["header"], g["paths"]) for g in groups])
