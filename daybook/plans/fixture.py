"""The given ``events`` table as Bronze input.

``events(event_id, ts, user_id, event_type, value, props)`` maps to the Bronze
columns as *text*, the way a producer would write them; some rows get fixed defects
chosen by ``event_id`` so that cleaning and every quality check have work to do.
Every row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schema import BRONZE_SCHEMA

# The defect rule shared with the SQL oracle. A row whose event_id is
# divisible by the number gets the defect; of several for a column the first counts.
NULL_USER_EVERY = 50
BAD_USER_EVERY = 59
NULL_PRODUCT_EVERY = 37
BAD_PRODUCT_EVERY = 61
BAD_TIMESTAMP_EVERY = 41
LATE_EVERY = 43
REPEATED_ID_EVERY = 17
NULL_AMOUNT_EVERY = 53
BAD_AMOUNT_EVERY = 67
NAN_AMOUNT_EVERY = 79
HUGE_AMOUNT_EVERY = 997
TINY_AMOUNT_EVERY = 73
NEGATIVE_AMOUNT_EVERY = 83
TIED_AMOUNT_EVERY = 23
BAD_USER_TEXT = "user-x"
BAD_PRODUCT_TEXT = "none"
BAD_TIMESTAMP_TEXT = "garbage"
BAD_AMOUNT_TEXT = "12.3.4"
HUGE_AMOUNT_TEXT = "1e25"
TINY_AMOUNT_TEXT = "1e-9"
NEGATIVE_AMOUNT_TEXT = "-5.25"
TIED_AMOUNT_TEXT = "9999.125"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_from_events(events: DataFrame) -> DataFrame:
    """Bronze columns as text plus ``process_date`` (the arrival date)."""
    eid = F.col("event_id")
    arrival = F.to_date("ts")

    def every(n: int):
        return eid % n == 0

    return events.select(
        F.when(every(REPEATED_ID_EVERY), F.concat(F.lit("again-"), arrival.cast("string")))
         .otherwise(eid.cast("string")).alias("event_id"),
        F.when(every(NULL_USER_EVERY), F.lit(None))
         .when(every(BAD_USER_EVERY), F.lit(BAD_USER_TEXT))
         .otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.col("event_type"),
        F.when(every(NULL_PRODUCT_EVERY), F.lit(None))
         .when(every(BAD_PRODUCT_EVERY), F.lit(BAD_PRODUCT_TEXT))
         .otherwise(F.get_json_object("props", "$.k")).alias("product_id"),
        F.when(every(BAD_TIMESTAMP_EVERY), F.lit(BAD_TIMESTAMP_TEXT))
         .when(every(LATE_EVERY), (F.col("ts") - F.expr("INTERVAL 1 DAY")).cast("string"))
         .otherwise(F.col("ts").cast("string")).alias("event_timestamp"),
        F.when(every(NULL_AMOUNT_EVERY), F.lit(None))
         .when(every(BAD_AMOUNT_EVERY), F.lit(BAD_AMOUNT_TEXT))
         .when(every(NAN_AMOUNT_EVERY), F.lit("NaN"))
         .when(every(HUGE_AMOUNT_EVERY), F.lit(HUGE_AMOUNT_TEXT))
         .when(every(TINY_AMOUNT_EVERY), F.lit(TINY_AMOUNT_TEXT))
         .when(every(NEGATIVE_AMOUNT_EVERY), F.lit(NEGATIVE_AMOUNT_TEXT))
         .when(every(TIED_AMOUNT_EVERY), F.lit(TIED_AMOUNT_TEXT))
         .when(F.col("event_type") == "purchase", F.col("value").cast("string"))
         .otherwise(F.lit("0.0")).alias("amount"),
        arrival.alias("process_date"),
    )


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Typed Bronze rows: text that is no value of its column's type becomes NULL."""
    raw = raw_from_events(events)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA],
                      "process_date")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given ``events`` table as typed Bronze rows with ``process_date``."""
    return bronze_from_events(read_table(spark, sf_dir, "events"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given ``events`` table as Bronze text with ``process_date``."""
    return raw_from_events(read_table(spark, sf_dir, "events"))
