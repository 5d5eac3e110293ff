"""The mart as a relational table over JDBC (S11).

Rows never pass through the driver: executors write them to a staging table
in parallel (``DataFrame.write.jdbc``); then one driver-side transaction creates
the mart if absent, deletes the loaded dates and copies the staging rows in, so
readers see the old or the new day, never a mix. Works with any JDBC database
whose driver is on the classpath; tests use embedded Derby, which ships with
Spark (an embedded database is visible to its own JVM only).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schema import MART_COLUMNS
from daybook.sources.mart import mart_rows_from_gold

STORED = ["process_date", *MART_COLUMNS, "created_at"]
DDL_TYPES = {
    "process_date": "DATE", "metric_date": "DATE", "daily_active_users": "INT",
    "total_revenue": "DOUBLE PRECISION", "top_product_id": "INT",
    "top_product_revenue": "DOUBLE PRECISION", "created_at": "TIMESTAMP",
}
MONEY = ["total_revenue", "top_product_revenue"]
# Connections a load opens at most to stage its rows (one row per date pair).
STAGING_PARTITIONS = 8


def _q(name: str) -> str:
    return f'"{name}"'


def _connect(spark: SparkSession, url: str, props: dict[str, str]):
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        if k != "driver":
            jprops.setProperty(k, v)
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, jprops)


def _columns(conn, table: str) -> list[str] | None:
    """Column names of the very table the quoted name means; None if there is none."""
    rs = None
    try:
        rs = conn.createStatement().executeQuery(f"SELECT * FROM {_q(table)} WHERE 1 = 0")
        meta = rs.getMetaData()
        return [meta.getColumnName(i + 1) for i in range(meta.getColumnCount())]
    except Exception:  # the drivers have no common error for a missing table
        conn.rollback()
        return None
    finally:
        if rs is not None:
            rs.close()


def _prepare_table(conn, stmt, table: str) -> None:
    """Create the mart if absent; give one without arrival dates that column.

    Rows that are there already are filed under their own date.
    """
    have = _columns(conn, table)
    if have is None:
        cols = ", ".join(f"{_q(c)} {DDL_TYPES[c]}" for c in STORED)
        stmt.executeUpdate(f"CREATE TABLE {_q(table)} ({cols})")
    elif "process_date" not in have:
        stmt.executeUpdate(f"ALTER TABLE {_q(table)} ADD COLUMN {_q('process_date')} DATE")
        stmt.executeUpdate(f"UPDATE {_q(table)} SET {_q('process_date')} = {_q('metric_date')}")


def load_mart_jdbc(spark: SparkSession, gold: DataFrame, url: str, dates: Iterable[str],
                   table: str = "daily_metrics", props: dict[str, str] | None = None) -> int:
    """Replace the mart rows of ``dates`` with ``gold``'s rows in one transaction.

    Returns the number of rows inserted. An empty Gold still deletes the dates.
    Executors commit staging rows per partition, so a task retried after a lost
    executor can stage its rows twice; the rows are identical (the load time is
    fixed once per query), and the copy selects them DISTINCT.
    """
    props = dict(props or {})
    dates = list(dict.fromkeys(dates))
    staging = f"{table}_stage_{uuid.uuid4().hex[:8]}"
    rows = mart_rows_from_gold(gold).select(*STORED)
    conn = _connect(spark, url, props)
    try:
        (rows.write.option("numPartitions", STAGING_PARTITIONS)
         .jdbc(url, _q(staging), mode="overwrite", properties=props))
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        _prepare_table(conn, stmt, table)
        delete = conn.prepareStatement(f"DELETE FROM {_q(table)} WHERE {_q('process_date')} = ?")
        jdate = spark.sparkContext._jvm.java.sql.Date
        for d in dates:
            delete.setDate(1, jdate.valueOf(d))
            delete.executeUpdate()
        names = ", ".join(_q(c) for c in STORED)
        inserted = stmt.executeUpdate(
            f"INSERT INTO {_q(table)} ({names}) SELECT DISTINCT {names} FROM {_q(staging)}")
        conn.commit()
    except Exception:
        if not conn.getAutoCommit():
            conn.rollback()
        raise
    finally:
        try:
            conn.setAutoCommit(False)
            if _columns(conn, staging) is not None:  # a failed write may leave none
                conn.createStatement().executeUpdate(f"DROP TABLE {_q(staging)}")
            conn.commit()
        finally:
            conn.close()
    return int(inserted)


def read_mart_jdbc(spark: SparkSession, url: str, table: str = "daily_metrics",
                   props: dict[str, str] | None = None) -> DataFrame:
    """The dashboard's view of a JDBC mart: all rows, money as double as in the Parquet mart."""
    df = spark.read.jdbc(url, _q(table), properties=dict(props or {}))
    return df.select(*MART_COLUMNS).withColumns({c: F.col(c).cast("double") for c in MONEY})
