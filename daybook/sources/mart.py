"""The metrics mart: one row per (arrival date, metric date), replaceable per date.

Stored as a Parquet table partitioned by arrival date. Loading a date replaces
that date's rows (delete + insert in one commit, see ``versions``); loading an empty
Gold for a date clears it. Dashboards read every row: a metric date has a row for each arrival date
that brought events of it, so late events show up beside the date's own delivery.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schema import MART_COLUMNS, MART_STORED_SCHEMA
from daybook.sources import fs, layers, versions


def mart_rows_from_gold(gold: DataFrame) -> DataFrame:
    """Gold rows → mart rows: rename the date, DAU as int, load time."""
    return gold.select(
        "process_date",
        F.to_date("event_date").alias("metric_date"),
        F.col("daily_active_users").cast("int").alias("daily_active_users"),
        F.col("total_revenue").cast("double").alias("total_revenue"),
        F.col("top_product_id").cast("int").alias("top_product_id"),
        F.col("top_product_revenue").cast("double").alias("top_product_revenue"),
        F.current_timestamp().alias("created_at"),
    )


def load_mart(spark: SparkSession, gold: DataFrame, root: str, dates: Iterable[str]) -> list[str]:
    """Replace the mart rows of ``dates`` with the given Gold rows.

    No shuffle: Gold holds one small file per arrival date and a file is never
    split, so every task writes one mart file per date it reads.
    """
    return layers.replace_dates(spark, mart_rows_from_gold(gold), root, dates)


def read_mart(spark: SparkSession, root: str, dates=None) -> DataFrame:
    """All stored mart rows with ``process_date``."""
    return layers.read_layer(spark, root, MART_STORED_SCHEMA, dates)


def mart_view(spark: SparkSession, root: str) -> DataFrame:
    """The dashboard's table: all rows, 5 columns."""
    return read_mart(spark, root).select(*MART_COLUMNS)


def own_date_view(spark: SparkSession, root: str) -> DataFrame:
    """Only the rows that arrived on their own date: late events are not in it."""
    m = read_mart(spark, root)
    return m.where(F.col("process_date") == F.col("metric_date")).select(*MART_COLUMNS)


STORED_TABLE = "mart_daily_metrics"


def create_table(spark: SparkSession, root: str, name: str = STORED_TABLE) -> str:
    """Register the stored mart in the session catalog (S8), then pick up its partitions.

    ``CREATE TABLE IF NOT EXISTS ... PARTITIONED BY ... LOCATION`` over the mart
    folder; call :func:`refresh_table` after loads to see new arrival dates.
    """
    cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}"
                     for f in MART_STORED_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, year INT, month INT, day INT) "
              f"USING parquet PARTITIONED BY (year, month, day) "
              f"LOCATION '{versions.data_root(root)}'")
    return refresh_table(spark, name)


def refresh_table(spark: SparkSession, name: str = STORED_TABLE) -> str:
    """Point the catalog's partitions to the folders of the newest commit.

    Dates that are gone or stand in another folder now are dropped and added anew; those
    that stayed are left alone. One statement for all of a kind.
    """
    base = _location(spark, name)
    held = {d: e.folders for d, e in versions.read_state(spark, base.removesuffix("/data")).dates.items()}
    if any(len(f) != 1 for f in held.values()):
        raise ValueError("a catalog partition has one folder: load the mart per date")
    wanted = {_partition(d): f"{base}/{f[0]}" for d, f in held.items()}
    known = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():  # one row a date
        spec = tuple(int(part.split("=")[1]) for part in row[0].split("/"))
        known[spec] = _location(spark, name, spec)
    same = {s for s, at in known.items() if s in wanted and fs.same_path(at, wanted[s])}
    gone, new = known.keys() - same, wanted.keys() - same
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP " + ", ".join(f"PARTITION ({_spec(s)})" for s in gone))
    if new:
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
            f"PARTITION ({_spec(s)}) LOCATION '{wanted[s]}'" for s in sorted(new)))
    spark.catalog.refreshTable(name)
    return name


def _partition(date: str) -> tuple[int, int, int]:
    return int(date[:4]), int(date[5:7]), int(date[8:10])


def _spec(partition: tuple[int, int, int]) -> str:
    return "year={}, month={}, day={}".format(*partition)


def _location(spark: SparkSession, name: str, partition: tuple[int, int, int] | None = None) -> str:
    """Folder of the table, or of one of its partitions."""
    which = f"{name} PARTITION ({_spec(partition)})" if partition else name
    rows = spark.sql(f"DESCRIBE EXTENDED {which}").collect()
    return next((r[1] for r in rows if r[0] == "Location"), "").rstrip("/")


def create_dashboard_view(spark: SparkSession, table: str = STORED_TABLE,
                          view: str = "daily_metrics") -> str:
    """The dashboard's table, all rows, as a SQL view over the catalog table."""
    cols = ", ".join(MART_COLUMNS)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS SELECT {cols} FROM {table}")
    return view
