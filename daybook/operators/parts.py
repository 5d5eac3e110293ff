"""Stored partial results beside Gold: what later arrivals are merged with, instead of recomputed.

Two tables, laid out by arrival date like the layers:

* **revenue parts** (event_date, product_id, bin, part): exact sums by exponent bin;
* **user sets** (event_date, bucket, users): the distinct users of a date as bitmaps, 32,768
  ids to a bucket. Sets merge by OR, so users of a metric date can be counted over several
  arrival dates without their events.

Both have a row for each group of a *delivery* (the files one run took in), so a delivery that
comes late adds its own rows and changes no others. Bitmaps are built on the map side: what is
shuffled is one bitmap a task, date and bucket, not a row a user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import gold

REVENUE_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType(), True),
    T.StructField("product_id", T.IntegerType(), True),
    T.StructField("bin", T.IntegerType(), True),
    T.StructField("part", T.DecimalType(38, 9), True),
])
USERS_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType(), True),
    T.StructField("bucket", T.LongType(), True),
    T.StructField("users", T.BinaryType(), True),
])
ARRIVAL_KEYS = ["process_date", "event_date"]


def user_sets(silver: DataFrame, keys=None) -> DataFrame:
    """(keys, bucket, users): the distinct users as one bitmap for each bucket of ids."""
    user = F.col("user_id").cast("bigint")
    return (silver.where(user.isNotNull())
            .groupBy(*(keys or ARRIVAL_KEYS), F.bitmap_bucket_number(user).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users")))


def merge_users(sets: DataFrame, keys) -> DataFrame:
    """(keys, bucket, users): the union over whatever else told the sets apart."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def count_users(sets: DataFrame, keys) -> DataFrame:
    """(keys, daily_active_users): users of the union, exactly; every bucket is counted once."""
    return merge_users(sets, keys).groupBy(*keys).agg(
        F.sum(F.bitmap_count("users")).cast("bigint").alias("daily_active_users"))


def arrival_gold(revenue: DataFrame, users: DataFrame) -> DataFrame:
    """Gold rows, one per arrival date and event date, from the stored parts."""
    return gold.gold_from_parts(gold.merge_parts(revenue, ARRIVAL_KEYS),
                                count_users(users, ARRIVAL_KEYS), ARRIVAL_KEYS)


def metric_dates(revenue: DataFrame, users: DataFrame) -> DataFrame:
    """One row for each metric date over all its arrivals, in the mart's columns.

    Users are counted once however many arrival dates saw them, revenue is summed exactly and
    the top product is that of the whole date. Reads the stored parts only.
    """
    keys = ["metric_date"]
    rev, sets = (df.withColumnRenamed("event_date", "metric_date") for df in (revenue, users))
    return gold.gold_from_parts(gold.merge_parts(rev, keys), count_users(sets, keys), keys).withColumn(
        "daily_active_users", F.col("daily_active_users").cast("int"))
