"""The synthetic event source."""

from pyspark.sql import functions as F

from daybook.operators import generate, silver
from daybook.plans import pipeline
from daybook.sources import bronze


def test_ranges_and_shares(spark):
    n = 1_000_000
    df = generate.generate_events(spark, "2026-01-12", n)
    s = df.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"),
        F.min("user_id").alias("umin"), F.max("user_id").alias("umax"),
        F.min("product_id").alias("pmin"), F.max("product_id").alias("pmax"),
        F.avg((F.col("event_type") == "view").cast("int")).alias("view"),
        F.avg((F.col("event_type") == "click").cast("int")).alias("click"),
        F.avg((F.col("event_type") == "purchase").cast("int")).alias("purchase"),
        F.min(F.when(F.col("event_type") == "purchase", F.col("amount"))).alias("amin"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("amount"))).alias("amax"),
        F.max(F.when(F.col("event_type") != "purchase", F.abs("amount"))).alias("other"),
        F.min("event_timestamp").alias("tmin"), F.max("event_timestamp").alias("tmax"),
    ).first()
    assert s.n == n and s.ids == n
    assert 1 <= s.umin and s.umax <= 100_000 and 1 <= s.pmin and s.pmax <= 5_000
    assert abs(s.view - 0.7) < 0.01 and abs(s.click - 0.2) < 0.01 and abs(s.purchase - 0.1) < 0.01
    assert 5.0 <= s.amin and s.amax <= 500.0 and s.other == 0.0
    assert s.tmin.startswith("2026-01-12T") and s.tmax.startswith("2026-01-12T")


def test_independent_of_partitioning(spark):
    a = generate.generate_events(spark, "2026-01-12", 5_000, partitions=1)
    b = generate.generate_events(spark, "2026-01-12", 5_000, partitions=7)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_generated_bronze_survives_cleaning(spark, root):
    paths = pipeline.Paths.under(root)
    bronze.write_bronze(generate.generate_events(spark, "2026-01-12", 20_000), paths.bronze)
    b = bronze.read_bronze(spark, paths.bronze, "2026-01-12")
    assert b.count() == 20_000
    s = silver.transform_to_silver(b)
    assert s.count() == 20_000
    assert s.where(F.col("event_date") != F.lit("2026-01-12").cast("date")).count() == 0
