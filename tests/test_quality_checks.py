"""Each quality check passes on good data and fails on bad data (Q3, Q4, Q6)."""

from pyspark.sql import functions as F

from conftest import write_csv
from daybook.operators import generate, quality
from daybook.plans import pipeline
from daybook.sources import bronze

HEADER = "event_id,user_id,event_type,product_id,event_timestamp,amount\n"
DAY = "2026-04-01"


def _generated(spark, root, n=3_000):
    paths = pipeline.Paths.under(root)
    bronze.write_bronze(generate.generate_events(spark, DAY, n), paths.bronze)
    return paths


def test_q3_key_completeness(spark, root):
    good = _generated(spark, root)
    counts = {r.column_name: r.null_count
              for r in quality.null_counts(bronze.read_bronze(spark, good.bronze)).collect()}
    assert set(counts.values()) == {0}
    bad = pipeline.Paths.under(root + "-bad")
    write_csv(bronze.date_path(bad.bronze, DAY), "a.csv", HEADER +
              "a,,view,1,2026-04-01T01:00:00,0.0\n,2,view,,2026-04-01T01:00:00,0.0\n")
    counts = {r.column_name: r.null_count
              for r in quality.null_counts(bronze.read_bronze(spark, bad.bronze)).collect()}
    assert counts["event_id"] == 1 and counts["user_id"] == 1 and counts["product_id"] == 1


def test_q4_reconciliation(spark, root):
    paths = _generated(spark, root)
    pipeline.run_dates(spark, paths, [DAY])
    b = bronze.read_bronze(spark, paths.bronze, DAY)
    s = pipeline.silver_for(spark, paths, [DAY])
    g = pipeline.gold_for(spark, paths, [DAY])
    assert quality.reconcile(b, s, g).first().passed is True
    # Silver that lost rows (or a Gold that is missing) does not reconcile.
    assert quality.reconcile(b, s.where(F.col("user_id") % 7 != 0), g).first().passed is False
    assert quality.reconcile(b, s, g.where(F.lit(False))).first().passed is False


def test_q6_idempotency(spark, root):
    paths = _generated(spark, root)
    pipeline.run_dates(spark, paths, [DAY])
    pipeline.load(spark, paths, [DAY])
    assert pipeline.verify_idempotent(spark, paths, [DAY]) == {"silver": 0, "gold": 0, "mart": 0}
    # A file lands for the date between runs: the rerun changes all layers, and it is reported.
    write_csv(bronze.date_path(paths.bronze, DAY), "late.csv",
              HEADER + "late-1,424242,purchase,7,2026-04-01T05:00:00,99.99\n")
    diff = pipeline.verify_idempotent(spark, paths, [DAY])
    assert diff == {"silver": 1, "gold": 1, "mart": 1}
