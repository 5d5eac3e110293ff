"""Schemas of the four layers."""

from pyspark.sql import types as T

# The Bronze columns and types in file order (CSV with a header;
# columns bind by position, all nullable), the key columns cleaning requires, and
# the column orders of Silver, Gold and the mart.
BRONZE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("user_id", T.IntegerType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.IntegerType(), True),
    T.StructField("event_timestamp", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
])
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# A Bronze line split into text fields (DDL for ``from_csv``).
BRONZE_TEXT_DDL = ", ".join(f"{c} STRING" for c in BRONZE_COLUMNS)

# The raw line of a Bronze row in which a typed field failed to convert (the CSV
# reader keeps the fields that did convert and stores the line here).
RAW_RECORD = "_raw_record"

# The arrival date is the Bronze directory: date=YYYY-MM-DD.
BRONZE_PARTITION = "date"

# Cleaning drops a row when any of these is NULL after typing.
KEY_COLUMNS = ["event_id", "user_id", "product_id", "event_timestamp"]

SILVER_COLUMNS = ["event_id", "user_id", "event_type", "product_id", "amount",
                  "event_timestamp", "event_date", "day_of_week"]

GOLD_COLUMNS = ["process_date", "event_date", "daily_active_users", "total_revenue",
                "top_product_id", "top_product_revenue"]

MART_COLUMNS = ["metric_date", "daily_active_users", "total_revenue", "top_product_id",
                "top_product_revenue"]

MART_SCHEMA = T.StructType([
    T.StructField("process_date", T.DateType(), True),
    T.StructField("metric_date", T.DateType(), True),
    T.StructField("daily_active_users", T.IntegerType(), True),
    T.StructField("total_revenue", T.DoubleType(), True),
    T.StructField("top_product_id", T.IntegerType(), True),
    T.StructField("top_product_revenue", T.DoubleType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

# Silver and Gold are laid out by arrival date as year=YYYY/month=MM/day=DD.
LAYOUT_COLUMNS = ["year", "month", "day"]

SILVER_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("user_id", T.IntegerType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.IntegerType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("event_timestamp", T.TimestampType(), True),
    T.StructField("event_date", T.DateType(), True),
    T.StructField("day_of_week", T.StringType(), True),
])

GOLD_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType(), True),
    T.StructField("daily_active_users", T.LongType(), True),
    T.StructField("total_revenue", T.DoubleType(), True),
    T.StructField("top_product_id", T.IntegerType(), True),
    T.StructField("top_product_revenue", T.DoubleType(), True),
])

# The mart as stored (process_date is the partition, see MART_SCHEMA for the view).
MART_STORED_SCHEMA = T.StructType([f for f in MART_SCHEMA.fields if f.name != "process_date"])
