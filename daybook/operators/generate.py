"""Synthetic raw events as a distributed Spark job (G1–G6).

Every column is a pure function of (date, row id), so the job scales with the
number of partitions, a lost task recomputes identical rows, and reruns are
repeatable. Rows: ``spark.range(n)`` or any DataFrame of ids.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import draw

# The event source's ranges and mix.
USERS = 100_000
PRODUCTS = 5_000
TYPE_SHARES = [("view", 70), ("click", 20), ("purchase", 10)]  # percent
AMOUNT_CENTS = (500, 50_000)  # 5.00 .. 500.00, both ends included
SECONDS_PER_DAY = 86_400
DEFAULT_ROWS = 1_000_000


def _event_type(u: Column) -> Column:
    expr, upper = None, 0
    for name, share in TYPE_SHARES:
        upper += share
        expr = F.when(u < upper, F.lit(name)) if expr is None else expr.when(u < upper, F.lit(name))
    return expr


def _uuid_text(h: Column) -> Column:
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def events_for_ids(ids: DataFrame, date: str, id_col: str = "id") -> DataFrame:
    """Bronze rows (plus ``process_date``) for each id, all on arrival date ``date``."""
    dt.date.fromisoformat(date)  # validate
    i = F.col(id_col)
    etype = _event_type(draw(date, "type", i) % 100)
    lo, hi = AMOUNT_CENTS
    cents = F.lit(lo) + draw(date, "amount", i) % (hi - lo + 1)
    start = F.lit(f"{date} 00:00:00").cast("timestamp_ntz")
    ts = F.timestamp_add("SECOND", draw(date, "time", i) % SECONDS_PER_DAY, start)
    key = F.concat_ws(":", F.lit(date), F.lit("event"), i.cast("string"))
    return ids.select(
        _uuid_text(F.md5(key)).alias("event_id"),
        (F.lit(1) + draw(date, "user", i) % USERS).cast("int").alias("user_id"),
        etype.alias("event_type"),
        (F.lit(1) + draw(date, "product", i) % PRODUCTS).cast("int").alias("product_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("event_timestamp"),
        F.when(etype == "purchase", cents / F.lit(100.0)).otherwise(F.lit(0.0)).alias("amount"),
        F.lit(date).cast("date").alias("process_date"),
    )


def generate_events(spark: SparkSession, date: str, n: int = DEFAULT_ROWS,
                    partitions: int | None = None) -> DataFrame:
    """``n`` events for ``date``; at least one partition per core, at most ~2M rows each."""
    partitions = partitions or max(spark.sparkContext.defaultParallelism, -(-n // 2_000_000))
    return events_for_ids(spark.range(0, n, 1, partitions), date)
