"""Edge cases of cleaning, aggregation and replace semantics."""

import pytest
from pyspark.sql import functions as F

from conftest import write_csv
from daybook.operators import gold, quality, silver
from daybook.plans import pipeline
from daybook.sources import bronze, mart

HEADER = "event_id,user_id,event_type,product_id,event_timestamp,amount\n"


def _gold_of(spark, root, day, body, name="a.csv"):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, day), name, HEADER + body)
    s = silver.transform_to_silver(bronze.read_bronze(spark, paths.bronze, day))
    return paths, {r.event_date.isoformat(): r for r in gold.aggregate_to_gold(s).collect()}


def test_tie_goes_to_smaller_product(spark, root):
    _, g = _gold_of(spark, root, "2026-02-01",
                    "a,1,purchase,7,2026-02-01T01:00:00,10.0\n"
                    "b,2,purchase,3,2026-02-01T02:00:00,10.0\n"
                    "c,3,purchase,9,2026-02-01T03:00:00,4.0\n")
    r = g["2026-02-01"]
    assert (r.top_product_id, r.top_product_revenue, r.total_revenue) == (3, 10.0, 24.0)


def test_day_without_purchases(spark, root):
    _, g = _gold_of(spark, root, "2026-02-02",
                    "a,1,view,8,2026-02-02T01:00:00,0.0\nb,2,click,5,2026-02-02T02:00:00,0.0\n")
    r = g["2026-02-02"]
    assert (r.daily_active_users, r.total_revenue, r.top_product_id, r.top_product_revenue) \
        == (2, 0.0, 5, 0.0)


def test_day_with_only_null_amounts(spark, root):
    _, g = _gold_of(spark, root, "2026-02-03",
                    "a,1,view,8,2026-02-03T01:00:00,\nb,2,click,5,2026-02-03T02:00:00,\n")
    r = g["2026-02-03"]
    assert r.daily_active_users == 2
    assert r.total_revenue is None and r.top_product_revenue is None
    assert r.top_product_id == 5


def test_nan_amount_is_not_revenue(spark, root):
    _, g = _gold_of(spark, root, "2026-02-04",
                    "a,1,purchase,8,2026-02-04T01:00:00,NaN\n"
                    "b,2,purchase,5,2026-02-04T02:00:00,3.5\n")
    r = g["2026-02-04"]
    assert (r.total_revenue, r.top_product_id, r.top_product_revenue) == (3.5, 5, 3.5)


def test_both_top_product_forms_agree_on_edge_cases(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-05"), "a.csv", HEADER +
              "a,1,purchase,7,2026-02-05T01:00:00,10.0\nb,2,purchase,3,2026-02-05T02:00:00,10.0\n"
              "c,3,view,1,2026-02-06T01:00:00,\nd,4,view,2,2026-02-07T01:00:00,0.0\n")
    s = silver.transform_to_silver(bronze.read_bronze(spark, paths.bronze, "2026-02-05"))
    per = gold.product_revenue_exact(s)
    w = sorted(gold.top_product(per).collect())
    m = sorted(gold.top_product_max_by(per).collect())
    assert w == m


def test_duplicate_event_ids_are_kept_and_reported(spark, root):
    paths, g = _gold_of(spark, root, "2026-02-08",
                        "a,1,purchase,8,2026-02-08T01:00:00,2.0\n"
                        "a,1,purchase,8,2026-02-08T01:00:00,2.0\n")
    assert g["2026-02-08"].total_revenue == 4.0
    cleaned = silver.transform_to_silver(bronze.read_bronze(spark, paths.bronze))
    d = quality.duplicate_ids(cleaned).collect()
    assert [(r.process_date.isoformat(), r.duplicate_rows) for r in d] == [("2026-02-08", 2)]


def test_header_only_file_gives_no_rows(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-09"), "a.csv", HEADER)
    assert bronze.read_bronze(spark, paths.bronze, "2026-02-09").count() == 0


def test_reordered_header_fails_the_run_before_silver(spark, root):
    from daybook.sources import fs
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-10"), "b.csv",
              HEADER + "b,2,view,8,2026-02-10T02:00:00,0.0\n")
    write_csv(bronze.date_path(paths.bronze, "2026-02-10"), "a.csv",
              "user_id,event_id,event_type,product_id,event_timestamp,amount\n"
              "1,a,view,8,2026-02-10T01:00:00,0.0\n")
    with pytest.raises(pipeline.GateError, match="header"):
        pipeline.run_gated(spark, paths, "2026-02-10")
    assert pipeline.silver_for(spark, paths, ["2026-02-10"]).count() == 0
    assert not fs.exists(spark, paths.gold) and not fs.exists(spark, paths.mart)


def test_failed_run_keeps_the_old_date(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-10"), "b.csv",
              HEADER + "b,2,view,8,2026-02-10T02:00:00,0.0\n")
    pipeline.run_gated(spark, paths, "2026-02-10")
    write_csv(bronze.date_path(paths.bronze, "2026-02-10"), "a.csv",
              "user_id,event_id,event_type,product_id,event_timestamp,amount\n"
              "1,a,view,8,2026-02-10T01:00:00,0.0\n")
    with pytest.raises(pipeline.GateError):
        pipeline.run_gated(spark, paths, "2026-02-10")
    assert [r.event_id for r in pipeline.silver_for(spark, paths, ["2026-02-10"]).collect()] == ["b"]
    assert mart.mart_view(spark, paths.mart).count() == 1


def test_extreme_product_ids(spark, root):
    """The least and the largest int as product id, alone and tied, in both top-1 forms."""
    low, high = -2147483648, 2147483647
    paths, g = _gold_of(spark, root, "2026-02-20",
                        f"a,1,purchase,{low},2026-02-20T01:00:00,2.0\n"
                        f"b,2,purchase,{high},2026-02-20T02:00:00,2.0\n")
    assert g["2026-02-20"].top_product_id == low  # a tie goes to the smaller id
    s = silver.transform_to_silver(bronze.read_bronze(spark, paths.bronze, "2026-02-20"))
    per = gold.product_revenue_exact(s)
    assert gold.top_product(per).collect() == gold.top_product_max_by(per).collect()


def test_revenue_is_not_rounded_by_row(spark, root):
    _, g = _gold_of(spark, root, "2026-02-21", "".join(
        f"e{i},1,purchase,8,2026-02-21T01:00:00,0.004\n" for i in range(1000)))
    assert g["2026-02-21"].total_revenue == 4.0


def test_amounts_without_an_exact_sum_fail_the_report(spark, root):
    paths, _ = _gold_of(spark, root, "2026-02-22",
                        "a,1,purchase,8,2026-02-22T01:00:00,Infinity\n"
                        "b,1,purchase,8,2026-02-22T01:00:00,6.0\n")
    pipeline.run_dates(spark, paths, ["2026-02-22"])
    with pytest.raises(pipeline.GateError, match="amount_summable"):
        pipeline.check_report(spark, paths, ["2026-02-22"])


def test_missing_date_raises_and_backfill_reports_it(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-03-01"), "a.csv",
              HEADER + "a,1,view,8,2026-03-01T01:00:00,0.0\n")
    with pytest.raises(bronze.MissingBronzeError):
        pipeline.daily_run(spark, paths, "2026-03-02")
    res = pipeline.backfill(spark, paths, "2026-03-01", "2026-03-03")
    assert res.dates == ["2026-03-01"] and res.missing == ["2026-03-02", "2026-03-03"]
    assert pipeline.gold_for(spark, paths).count() == 1


def test_rerun_where_a_date_loses_all_rows_clears_it(spark, root):
    paths = pipeline.Paths.under(root)
    d = bronze.date_path(paths.bronze, "2026-03-05")
    write_csv(d, "a.csv", HEADER + "a,1,view,8,2026-03-05T01:00:00,0.0\n")
    pipeline.daily_run(spark, paths, "2026-03-05")
    pipeline.load(spark, paths, ["2026-03-05"])
    assert pipeline.gold_for(spark, paths, ["2026-03-05"]).count() == 1
    # The date is re-delivered with only a bad row.
    write_csv(d, "a.csv", HEADER + "a,1,view,8,garbage,0.0\n")
    res = pipeline.daily_run(spark, paths, "2026-03-05")
    assert res.cleared_silver == ["2026-03-05"] and res.cleared_gold == ["2026-03-05"]
    assert pipeline.silver_for(spark, paths, ["2026-03-05"]).count() == 0
    assert pipeline.gold_for(spark, paths, ["2026-03-05"]).count() == 0
    pipeline.load(spark, paths, ["2026-03-05"])
    assert mart.read_mart(spark, paths.mart).count() == 0
    with pytest.raises(pipeline.GateError):
        pipeline.check_layers(spark, paths, "2026-03-05")


def test_rerun_with_spill_does_not_duplicate(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-03-07"), "a.csv", HEADER +
              "a,1,purchase,8,2026-03-07T01:00:00,3.0\nb,2,purchase,9,2026-03-08T00:00:00,4.0\n")
    for _ in range(2):
        pipeline.daily_run(spark, paths, "2026-03-07")
        pipeline.load(spark, paths, ["2026-03-07"])
    stored = mart.read_mart(spark, paths.mart).collect()
    assert sorted(r.metric_date.isoformat() for r in stored) == ["2026-03-07", "2026-03-08"]
    assert sorted(r.metric_date.isoformat() for r in mart.mart_view(spark, paths.mart).collect()) \
        == ["2026-03-07", "2026-03-08"]
    assert [r.metric_date.isoformat() for r in mart.own_date_view(spark, paths.mart).collect()] \
        == ["2026-03-07"]
    spill = quality.date_spill(pipeline.silver_for(spark, paths, None)).collect()
    assert [(r.process_date.isoformat(), r.spilled_rows) for r in spill] == [("2026-03-07", 1)]


def test_header_check_with_many_splits_per_file(spark, root):
    paths = pipeline.Paths.under(root)
    body = "".join(f"e{i},{i % 9 + 1},view,8,2026-02-11T01:00:00,0.0\n" for i in range(3000))
    write_csv(bronze.date_path(paths.bronze, "2026-02-11"), "big.csv", HEADER + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = bronze.read_bronze(spark, paths.bronze, "2026-02-11")
        assert rows.rdd.getNumPartitions() > 5 and rows.select("user_id").distinct().count() == 9
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_cast_failures_are_the_csv_readers_own(spark, root):
    """A padded number is rejected by the CSV reader (the pipeline sees NULL), so it
    counts, even though a text cast would trim it; short and long rows do not."""
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-12"), "a.csv", HEADER +
              "a, 12,view,8,2026-02-12T01:00:00,0.0\n"
              "b,3,view,x9,2026-02-12T01:00:00,abc\n"
              "c,4,view\n"
              "d,5,view,8,2026-02-12T01:00:00,0.0,extra\n"
              "e,6,view,8,2026-02-12T01:00:00,\n")
    checked = bronze.read_bronze_checked(spark, paths.bronze, "2026-02-12")
    typed = bronze.read_bronze(spark, paths.bronze, "2026-02-12")
    cols = ["event_id", "user_id", "product_id", "amount"]
    assert sorted(checked.select(*cols).collect()) == sorted(typed.select(*cols).collect())
    fails = {r.column_name: r.failures for r in quality.cast_failures(checked).collect()}
    assert fails == {"user_id": 1, "product_id": 1, "amount": 1, "event_timestamp": 0}


def test_amounts_the_exact_sum_cannot_use_are_reported(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-13"), "a.csv", HEADER +
              "a,1,purchase,8,2026-02-13T01:00:00,NaN\n"
              "b,2,purchase,8,2026-02-13T01:00:00,Infinity\n"
              "c,3,purchase,8,2026-02-13T01:00:00,1.0E23\n"
              "d,4,purchase,8,2026-02-13T01:00:00,12.5\n")
    b = bronze.read_bronze(spark, paths.bronze, "2026-02-13")
    checks = {r.check: r.failures for r in quality.numeric_validity(b).collect()}
    assert checks["amount_summable"] == 2  # NaN and the infinity; 1e23 has an exact sum
    s = silver.transform_to_silver(b)
    (g,) = gold.aggregate_to_gold(s).collect()
    assert g.total_revenue == 1e23  # 100000000000000000000012.5, rounded once
    (g,) = gold.aggregate_to_gold(s.where("event_id <> 'c'")).collect()
    assert g.total_revenue == 12.5


# FIXTURES.md §3: timestamp text and what it becomes (session zone UTC).
TIMESTAMPS = [
    ("2026", "2026-01-01 00:00:00"),
    ("2026-01", "2026-01-01 00:00:00"),
    ("2026-01-12", "2026-01-12 00:00:00"),
    ("2026-01-12T01:02:03Z", "2026-01-12 01:02:03"),
    ("2026-01-12T01:02:03+02:00", "2026-01-11 23:02:03"),
    (" 2026-01-12 01:02:03 ", "2026-01-12 01:02:03"),
    ("2026-01-12T01:02:03.123456789", "2026-01-12 01:02:03.123456"),
    ("2026-13-01", None),
    ("garbage", None),
]


def test_timestamp_text_accepted_by_cleaning(spark, root):
    import datetime as dt
    paths = pipeline.Paths.under(root)
    body = "".join(f'id{i},1,view,1,"{text}",0.0\n' for i, (text, _) in enumerate(TIMESTAMPS))
    body += "today,1,view,1,12:30,0.0\n"
    write_csv(bronze.date_path(paths.bronze, "2026-01-12"), "a.csv", HEADER + body)
    rows = {r.event_id: r for r in silver.transform_to_silver(
        bronze.read_bronze(spark, paths.bronze, "2026-01-12")).collect()}
    for i, (text, want) in enumerate(TIMESTAMPS):
        got = rows.get(f"id{i}")
        if want is None:
            assert got is None, text
        else:
            got_text = got.event_timestamp.replace(tzinfo=None).isoformat(sep=" ")
            assert got_text.rstrip("0").rstrip(".") == want.rstrip("0").rstrip("."), text
    # A time without a date is taken as today (the documented Spark behaviour); the
    # test may straddle midnight UTC, so yesterday is accepted too.
    today = dt.datetime.now(dt.timezone.utc).date()
    assert rows["today"].event_date in (today, today - dt.timedelta(days=1))


def test_windows_line_endings(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-14"), "a.csv",
              HEADER.replace("\n", "\r\n") + "a,1,view,10,2026-02-14T00:00:01,1.5\r\n")
    (row,) = bronze.read_bronze(spark, paths.bronze, "2026-02-14").collect()
    assert row.amount == 1.5 and row.event_id == "a"


def test_byte_order_mark_in_header(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-15"), "a.csv",
              "\ufeff" + HEADER + "a,1,view,10,2026-02-15T00:00:01,1.5\n")
    (row,) = bronze.read_bronze(spark, paths.bronze, "2026-02-15").collect()
    assert row.event_id == "a" and row.amount == 1.5


def test_replacing_a_date_from_its_own_rows(spark, root):
    """Overwriting a partition that the same job reads (e.g. re-cleaning Silver in
    place): the new files are staged and swapped in at commit, after the read."""
    from daybook.sources import layers
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-16"), "a.csv", HEADER +
              "a,1,view,10,2026-02-16T00:00:01,1.5\nb,2,view,11,2026-02-16T00:00:02,2.5\n")
    pipeline.daily_run(spark, paths, "2026-02-16")
    current = pipeline.silver_for(spark, paths, ["2026-02-16"])
    layers.replace_dates(spark, current.where(F.col("event_id") == "a"), paths.silver,
                         ["2026-02-16"])
    assert [r.event_id for r in pipeline.silver_for(spark, paths, ["2026-02-16"]).collect()] \
        == ["a"]
    # The layout is derived from process_date again, so no unpadded twin folder appears.
    (folder,) = layers.date_folders(spark, paths.silver, "2026-02-16")
    assert folder.endswith("/year=2026/month=02/day=16")


def test_layout_across_a_year_boundary(spark, root):
    import datetime as dt
    from daybook.sources import layers
    paths = pipeline.Paths.under(root)
    for day in ["2025-12-31", "2026-01-01"]:
        write_csv(bronze.date_path(paths.bronze, day), "a.csv",
                  HEADER + f"a,1,view,10,{day}T23:59:59,1.5\n")
    res = pipeline.backfill(spark, paths, "2025-12-31", "2026-01-01")
    assert res.dates == ["2025-12-31", "2026-01-01"]
    for day, at in (("2025-12-31", "year=2025/month=12/day=31"), ("2026-01-01", "year=2026/month=01/day=01")):
        (folder,) = layers.date_folders(spark, paths.silver, day)
        assert folder.endswith(at)
    got = sorted((r.process_date, r.event_date) for r in pipeline.gold_for(spark, paths).collect())
    assert got == [(dt.date(2025, 12, 31), dt.date(2025, 12, 31)),
                   (dt.date(2026, 1, 1), dt.date(2026, 1, 1))]


def test_folder_with_only_a_success_marker_is_missing(spark, root):
    paths = pipeline.Paths.under(root)
    write_csv(bronze.date_path(paths.bronze, "2026-02-17"), "_SUCCESS", "")
    write_csv(bronze.date_path(paths.bronze, "2026-02-18"), "a.csv",
              HEADER + "a,1,view,10,2026-02-18T00:00:01,1.5\n")
    have, missing = bronze.present_dates(spark, paths.bronze, ["2026-02-17", "2026-02-18"])
    assert have == ["2026-02-18"] and missing == ["2026-02-17"]
    with pytest.raises(bronze.MissingBronzeError):
        bronze.require_bronze(spark, paths.bronze, "2026-02-17")
