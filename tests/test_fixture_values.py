"""Golden values published in FIXTURES.md §5 for the given tables, at all three scales."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from daybook.operators import gold, quality, silver
from daybook.plans import fixture

GOLD_KEYS = ["process_date", "event_date"]


def published_bronze(spark, sf_dir):
    """The mapping FIXTURES.md gives, with its four defects only."""
    eid = F.col("event_id")
    return fixture.read_table(spark, sf_dir, "events").select(
        eid.cast("string").alias("event_id"),
        F.when(eid % 50 != 0, F.col("user_id").cast("int")).alias("user_id"), "event_type",
        F.when(eid % 37 != 0, F.get_json_object("props", "$.k").cast("int")).alias("product_id"),
        F.when(eid % 41 == 0, "garbage").otherwise(F.col("ts").cast("string"))
        .alias("event_timestamp"),
        F.when(eid % 53 != 0, F.when(F.col("event_type") == "purchase", F.col("value"))
               .otherwise(F.lit(0.0))).alias("amount"),
        F.to_date("ts").alias("process_date"))


# FIXTURES.md §5 (Silver rows, Gold rows, sum of DAU, and the Gold row of
# 2024-01-01 as DAU, revenue, top product, top product revenue).
PUBLISHED = {
    "/root/testdata/sf0.001": (929, 30, 390, (15, 56.95, 97, 40.34)),
    "/root/testdata/sf0.01": (9302, 30, 3918, (132, 3220.89, 52, 346.53)),
    "/root/testdata/sf0.1": (93025, 30, 39259, (1312, 28974.85, 51, 758.15)),
}


@pytest.mark.parametrize("sf_dir", sorted(PUBLISHED))
def test_gold_matches_published_values(spark, sf_dir):
    silver_rows, gold_rows, dau_sum, first = PUBLISHED[sf_dir]
    cleaned = silver.transform_to_silver(published_bronze(spark, sf_dir))
    assert cleaned.count() == silver_rows
    rows = gold.aggregate_to_gold(cleaned, GOLD_KEYS).collect()
    assert len(rows) == gold_rows
    assert sum(r.daily_active_users for r in rows) == dau_sum
    (day1,) = [r for r in rows if r.event_date == dt.date(2024, 1, 1)]
    assert (day1.daily_active_users, day1.total_revenue, day1.top_product_id,
            day1.top_product_revenue) == first


# FIXTURES.md §5 (rejected rows; NULL user, product and amount; number of
# (date, product) groups).
PUBLISHED_COUNTS = {
    "/root/testdata/sf0.001": (71, (20, 28, 19), 800),
    "/root/testdata/sf0.01": (698, (200, 271, 189), 2867),
    "/root/testdata/sf0.1": (6975, (2000, 2703, 1887), 3000),
}


@pytest.mark.parametrize("sf_dir", sorted(PUBLISHED_COUNTS))
def test_counts_match_published_values(spark, sf_dir):
    rejected, nulls, groups = PUBLISHED_COUNTS[sf_dir]
    bronze = published_bronze(spark, sf_dir)
    assert bronze.where(silver.rejected(bronze)).count() == rejected
    counts = {r.column_name: r.null_count for r in quality.null_counts(bronze).collect()}
    assert (counts["user_id"], counts["product_id"], counts["amount"]) == nulls
    assert gold.product_revenue(silver.transform_to_silver(bronze)).count() == groups
