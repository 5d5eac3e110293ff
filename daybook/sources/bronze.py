"""Bronze: raw event CSV files by arrival date, ``<root>/date=YYYY-MM-DD/*.csv``."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schema import BRONZE_COLUMNS, BRONZE_PARTITION, BRONZE_SCHEMA, RAW_RECORD
from daybook.sources import fs


class MissingBronzeError(ValueError):
    """No Bronze file for a requested arrival date."""


class HeaderError(ValueError):
    """A Bronze file's header differs from the declared columns."""


@contextmanager
def header_errors():
    """Raise the CSV reader's complaint about a file's header as :class:`HeaderError`."""
    try:
        yield
    except Exception as e:
        text = str(e)
        if "CSV header" in text or "number of columns in CSV" in text.lower():
            at = text.find("CSV header")
            raise HeaderError(text[max(at, 0):][:400]) from e
        raise


def date_path(root: str, date: str) -> str:
    """The Bronze folder of one arrival date."""
    return f"{root.rstrip('/')}/{BRONZE_PARTITION}={date}"


def _schema(base: T.StructType) -> T.StructType:
    # The directory value is typed by the schema, so it reads back as a date.
    return T.StructType(base.fields + [T.StructField(BRONZE_PARTITION, T.DateType(), True)])


def _reader(spark: SparkSession, base: T.StructType, mode: str = "PERMISSIVE"):
    # enforceSchema=false: a file whose header differs from the schema fails as it is
    # opened. Columns bind by position, so it would be misread without a sign.
    reader = (spark.read.option("header", True).option("mode", mode)
              .option("enforceSchema", False).schema(_schema(base)))
    if RAW_RECORD in base.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", RAW_RECORD)
    return reader


def _load(spark: SparkSession, root: str, dates: Iterable[str] | None, base: T.StructType):
    reader = _reader(spark, base)
    if dates is None:
        df = reader.csv(root)
    else:
        paths = list(dict.fromkeys(date_path(root, d) for d in dates))  # each folder once
        present = [p for p, ok in zip(paths, fs.map_paths(lambda p: fs.exists(spark, p), paths))
                   if ok]
        if not present:
            return spark.createDataFrame([], _schema(base)).withColumnRenamed(
                BRONZE_PARTITION, "process_date")
        # Only the requested directories are listed; basePath keeps the date column.
        df = reader.option("basePath", root).csv(present)
    return df.withColumnRenamed(BRONZE_PARTITION, "process_date")


def read_bronze(spark: SparkSession, root: str, dates: Iterable[str] | str | None = None
                ) -> DataFrame:
    """Typed Bronze rows plus ``process_date``.

    Columns bind by position under the fixed schema (PERMISSIVE): a malformed
    number becomes NULL, a short row gets trailing NULLs, extra fields are
    ignored, a header-only file gives no rows. A file with another header fails the
    read (see :func:`header_errors`).
    """
    if isinstance(dates, str):
        dates = [dates]
    return _load(spark, root, dates, BRONZE_SCHEMA)


def read_files(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Typed Bronze rows of the files of these names below the root."""
    if not names:
        return spark.createDataFrame([], _schema(BRONZE_SCHEMA)).withColumnRenamed(
            BRONZE_PARTITION, "process_date")
    at = root.rstrip("/")
    return (_reader(spark, BRONZE_SCHEMA).option("basePath", at).csv([f"{at}/{n}" for n in names])
            .withColumnRenamed(BRONZE_PARTITION, "process_date"))


def read_bronze_checked(spark: SparkSession, root: str, dates=None) -> DataFrame:
    """Typed Bronze plus ``_raw_record``: the raw line of every row in which a typed
    field failed to convert (NULL otherwise). Same typed values as
    :func:`read_bronze`; one scan serves both the pipeline's view and the checks.
    """
    if isinstance(dates, str):
        dates = [dates]
    base = T.StructType(BRONZE_SCHEMA.fields + [T.StructField(RAW_RECORD, T.StringType(), True)])
    return _load(spark, root, dates, base)


def write_bronze(df: DataFrame, root: str, mixed_dates: bool = False) -> None:
    """Write Bronze rows (with ``process_date``) as CSV with a header, one folder per
    arrival date. A rerun replaces only the dates it writes.

    With ``mixed_dates`` rows are first brought together by date (``rebalance``: AQE
    splits large dates and merges small ones), because otherwise every task writes a
    file for each date it holds. Input of one date needs no such shuffle.

    Values are written as they are: Spark's CSV writer trims surrounding spaces
    unless told not to, and the reader (which does not trim) must get them back.
    """
    _write(df, root, "overwrite", mixed_dates)


def add_files(df: DataFrame, root: str, columns=None) -> None:
    """Land further files beside those that the arrival dates have (a late delivery).

    ``columns`` are the file's columns in order, where they differ from the declared ones.
    """
    _write(df, root, "append", True, columns or BRONZE_COLUMNS)


def _write(df: DataFrame, root: str, mode: str, mixed_dates: bool, columns=BRONZE_COLUMNS) -> None:
    out = df.select(*columns, F.col("process_date").alias(BRONZE_PARTITION))
    if mixed_dates:
        out = out.hint("rebalance", BRONZE_PARTITION)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .partitionBy(BRONZE_PARTITION).csv(root))


def bronze_files(spark: SparkSession, root: str, dates: Iterable[str] | str) -> DataFrame:
    """(path, length) of the files of the arrival dates; contents are not read.

    A date without a folder raises :class:`MissingBronzeError`.
    """
    dates = [dates] if isinstance(dates, str) else list(dates)
    from pyspark.errors import AnalysisException
    try:
        return (spark.read.format("binaryFile").load([date_path(root, d) for d in dates])
                .select("path", "length"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise MissingBronzeError(f"No bronze files found for {', '.join(dates)}") from e
        raise


def require_bronze(spark: SparkSession, root: str, date: str) -> int:
    """Gate: the date must have at least one Bronze file. Returns the file count."""
    files = fs.data_files(spark, date_path(root, date))
    if not files:
        raise MissingBronzeError(f"No bronze files found for {date}")
    return len(files)


def present_dates(spark: SparkSession, root: str, dates: Iterable[str]) -> tuple[list, list]:
    """Split requested dates into (with files, without files)."""
    dates = list(dates)
    found = fs.map_paths(lambda p: fs.first_data_file(spark, p),
                         [date_path(root, d) for d in dates])
    have = [d for d, f in zip(dates, found) if f]
    missing = [d for d, f in zip(dates, found) if not f]
    return have, missing
