"""Backfill = daily runs, idempotent reruns, gates, streaming ingest, JDBC mart."""

import pytest
from pyspark.sql import functions as F

from daybook.operators import dashboard
from daybook.schema import GOLD_COLUMNS
from daybook.plans import pipeline, warehouse
from daybook.session import scratch_dir
from daybook.sources import bronze, jdbc, layers, mart
from daybook.streaming import ingest
from conftest import SF_SMALL

DATES = ["2024-01-03", "2024-01-04", "2024-01-05"]


@pytest.fixture(scope="module")
def landed(spark):
    """The sf0.001 events as Bronze CSV (all 30 dates)."""
    root = scratch_dir(spark, "landed")
    paths = pipeline.Paths.under(root)
    warehouse.write_fixture_bronze(spark, SF_SMALL, paths.bronze)
    return paths


def _fresh(spark, landed):
    return pipeline.Paths.under(scratch_dir(spark, "p"), bronze_root=landed.bronze)


def _sorted_gold(spark, paths):
    return sorted(tuple(r) for r in pipeline.gold_for(spark, paths)
                  .select(*GOLD_COLUMNS).collect())


def test_backfill_equals_daily_runs(spark, landed):
    a, b = _fresh(spark, landed), _fresh(spark, landed)
    pipeline.backfill(spark, a, DATES[0], DATES[-1])
    for d in DATES:
        pipeline.daily_run(spark, b, d)
    assert _sorted_gold(spark, a) == _sorted_gold(spark, b)
    assert len(_sorted_gold(spark, a)) >= 3


def test_run_twice_equals_run_once(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    once = _sorted_gold(spark, p)
    # The rerun replaces the files, so the first result is taken before it.
    silver_once = sorted(repr(r) for r in pipeline.silver_for(spark, p, DATES).collect())
    pipeline.run_dates(spark, p, DATES)
    assert _sorted_gold(spark, p) == once
    assert sorted(repr(r) for r in pipeline.silver_for(spark, p, DATES).collect()) == silver_once


def test_gates_stop_later_steps(spark, landed):
    p = _fresh(spark, landed)
    with pytest.raises(bronze.MissingBronzeError):
        pipeline.run_gated(spark, p, "2023-12-31")
    from daybook.sources import fs
    assert not fs.exists(spark, p.silver) and not fs.exists(spark, p.mart)
    steps = pipeline.run_gated(spark, p, DATES[0])
    assert steps["layers"]["gold"] >= 1
    assert mart.mart_view(spark, p.mart).count() == steps["layers"]["gold"]


def test_streaming_ingest_processes_landed_dates(spark, landed):
    p = _fresh(spark, landed)
    q = ingest.start(spark, p, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    assert mart.own_date_view(spark, p.mart).count() == 30
    full = _fresh(spark, landed)
    dates = warehouse.bronze_dates(spark, landed.bronze)
    pipeline.run_dates(spark, full, dates)
    assert _sorted_gold(spark, p) == _sorted_gold(spark, full)


def test_jdbc_mart_replace_on_embedded_derby(spark, landed, tmp_path):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    url = f"jdbc:derby:{tmp_path}/mart_db;create=true"
    gold = pipeline.gold_for(spark, p, DATES)
    n = gold.count()
    assert jdbc.load_mart_jdbc(spark, gold, url, DATES) == n
    assert jdbc.load_mart_jdbc(spark, gold, url, DATES) == n
    got = jdbc.read_mart_jdbc(spark, url)
    assert got.count() == n
    pipeline.load(spark, p, DATES)
    parquet = mart.mart_view(spark, p.mart)
    cols = ["metric_date", "daily_active_users", "total_revenue", "top_product_id",
            "top_product_revenue"]
    assert sorted(got.select(*cols).collect()) == sorted(parquet.select(*cols).collect())
    # Rows staged twice (a retried task) are inserted once.
    twice = gold.unionByName(gold)
    assert jdbc.load_mart_jdbc(spark, twice, url, DATES) == n
    assert jdbc.read_mart_jdbc(spark, url).count() == n
    # An empty load for a date clears it.
    empty = gold.where(F.lit(False))
    jdbc.load_mart_jdbc(spark, empty, url, [DATES[0]])
    left = gold.where(F.col("process_date") != F.lit(DATES[0]).cast("date")).count()
    assert jdbc.read_mart_jdbc(spark, url).count() == left


def test_dashboard_on_empty_mart(spark, root):
    p = pipeline.Paths.under(root)
    m = mart.mart_view(spark, p.mart)
    assert m.count() == 0
    assert dashboard.latest(m).count() == 0
    assert dashboard.page(m)["message"] == dashboard.EMPTY_MESSAGE


def test_dashboard_page_matches_the_queries(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    pipeline.load(spark, p, DATES)
    view = mart.mart_view(spark, p.mart)
    pg = dashboard.page(view)
    assert pg["table"] == dashboard.table(view).collect()
    assert pg["kpi"] == dashboard.latest(view).first().asDict()
    assert pg["dau_series"] == [tuple(r) for r in
                                dashboard.series(view, "daily_active_users").collect()]
    assert not view.is_cached


def test_partition_pruning_in_plan(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    silver = pipeline.silver_for(spark, p, None).where(
        F.col("process_date") == F.lit("2024-01-04").cast("date"))
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    assert silver.count() > 0


def test_idempotency_check_and_mart_count_gate(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    pipeline.load(spark, p, DATES)
    assert pipeline.verify_idempotent(spark, p, DATES) == {"silver": 0, "gold": 0, "mart": 0}
    n = pipeline.check_mart_count(spark, p, DATES[1])
    assert n >= 1
    with pytest.raises(pipeline.GateError):
        pipeline.check_mart_count(spark, p, DATES[1], expected=n + 1)
    # a row that was loaded twice is found
    again = mart.read_mart(spark, p.mart, [DATES[1]])
    layers.write_layer(again.withColumn("process_date", F.lit("2024-02-09").cast("date")), p.mart)
    with pytest.raises(pipeline.GateError):
        pipeline.check_mart_count(spark, p, DATES[1])
    with pytest.raises(pipeline.GateError):
        pipeline.check_mart_count(spark, p, "2023-01-01")


def test_bronze_file_listing(spark, landed):
    files = bronze.bronze_files(spark, landed.bronze, DATES[0])
    assert files.columns == ["path", "length"]
    rows = files.collect()
    assert rows and all(r.length > 0 and "date=2024-01-03" in r.path for r in rows)
    assert bronze.require_bronze(spark, landed.bronze, DATES[0]) == len(rows)


def test_dashboard_sql_on_registered_view(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    pipeline.load(spark, p, DATES)
    view = mart.mart_view(spark, p.mart)
    dashboard.register_view(spark, view)
    assert sorted(spark.sql(dashboard.DASHBOARD_SQL).collect()) == \
        sorted(dashboard.table(view).collect())
    assert spark.sql(dashboard.COUNT_SQL.format(date=DATES[1])).first()[0] == \
        dashboard.count_by_date(view, DATES[1]).first()[0] >= 1
    n, dau = spark.sql(dashboard.SUMMARY_SQL).first()
    s = dashboard.summary(view).first()
    assert (n, dau) == (s.row_count, s.dau_sum)
    assert len(spark.sql(dashboard.PREVIEW_SQL.format(date=DATES[0])).collect()) == \
        dashboard.count_by_date(view, DATES[0]).first()[0]
    r = spark.sql(dashboard.ROUNDED_SQL.format(date=DATES[2])).first()
    assert float(r.revenue) == dashboard.revenue_rounded(view, DATES[2]).first().revenue


def test_bronze_rewrite_of_a_date_replaces_it(spark, root):
    from daybook.operators import generate
    paths = pipeline.Paths.under(root)
    bronze.write_bronze(generate.generate_events(spark, "2026-01-12", 1_000), paths.bronze)
    bronze.write_bronze(generate.generate_events(spark, "2026-01-13", 500), paths.bronze)
    bronze.write_bronze(generate.generate_events(spark, "2026-01-12", 300), paths.bronze)
    counts = {r.process_date.isoformat(): r["count"] for r in
              bronze.read_bronze(spark, paths.bronze).groupBy("process_date").count().collect()}
    assert counts == {"2026-01-12": 300, "2026-01-13": 500}


def test_cli_gated_run_with_generation(spark, root):
    from daybook.__main__ import main
    out = main(["run", "--root", root, "--process-date", "2026-01-12", "--generate", "5000"])
    assert out["silver_rows"] == 5000 and out["gold_rows"] == 1 and out["mart_rows"] == 1
    out = main(["backfill", "--root", root, "--start", "2026-01-11", "--end", "2026-01-12",
                "--load"])
    assert out["dates"] == ["2026-01-12"] and out["missing"] == ["2026-01-11"]
    with pytest.raises(bronze.MissingBronzeError):
        bronze.bronze_files(spark, pipeline.Paths.under(root).bronze, "2026-01-11")
    rep = main(["report", "--root", root, "--process-date", "2026-01-12"])
    assert rep["checks"] == 17 and rep["failed"] == []


def test_streaming_ingest_only_handles_new_dates(spark, root):
    from daybook.operators import generate
    from daybook.session import scratch_dir as sd
    paths = pipeline.Paths.under(root)
    ckpt = sd(spark, "ckpt")
    bronze.write_bronze(generate.generate_events(spark, "2026-01-12", 2_000), paths.bronze)
    q = ingest.start(spark, paths, checkpoint=ckpt)
    q.awaitTermination(300)
    first = [p["numInputRows"] for p in q.recentProgress]
    assert sum(first) > 0
    assert mart.mart_view(spark, paths.mart).count() == 1
    bronze.write_bronze(generate.generate_events(spark, "2026-01-13", 1_000), paths.bronze)
    q2 = ingest.start(spark, paths, checkpoint=ckpt)
    q2.awaitTermination(300)
    # Only the new date's files are new input; both dates are in the mart once.
    new_files = sum(p["numInputRows"] for p in q2.recentProgress)
    assert 0 < new_files <= len(bronze.bronze_files(spark, paths.bronze, "2026-01-13").collect())
    view = mart.mart_view(spark, paths.mart).collect()
    assert sorted(r.metric_date.isoformat() for r in view) == ["2026-01-12", "2026-01-13"]


def test_quality_report_and_gate(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    pipeline.load(spark, p, DATES)
    rep = {(r.process_date.isoformat(), r.check): r
           for r in pipeline.quality_report(spark, p, DATES).collect()}
    assert len(rep) == 3 * 17
    r = rep[(DATES[0], "rows_reconciled")]
    assert r.observed == 0 and r.passed
    assert rep[(DATES[0], "mart_rows")].observed >= 1
    # The fixture has event types outside view/click/purchase: reported, not required.
    assert not rep[(DATES[0], "event_type_known")].passed
    assert pipeline.check_report(spark, p, DATES, required=("bronze_rows", "rows_reconciled")) == []
    with pytest.raises(pipeline.GateError):
        pipeline.check_report(spark, p, DATES, required=("event_type_known",))


def test_shuffle_sizing_follows_input_size(spark):
    from daybook.session import session_sized_for, shuffle_partitions_for
    gib = 1024 ** 3
    assert shuffle_partitions_for(10 * 1024 ** 2, 200) == 200
    assert shuffle_partitions_for(100 * gib, 200) == 400
    assert shuffle_partitions_for(100 * 1024 * gib, 200) == 409_600  # 100 TB: no cap
    before = spark.conf.get("spark.sql.shuffle.partitions")
    own = session_sized_for(spark, 1024 * gib)
    assert own.conf.get("spark.sql.shuffle.partitions") == "4096"
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_repeated_dates_are_read_once(spark, landed):
    p = _fresh(spark, landed)
    res = pipeline.run_dates(spark, p, [DATES[0], DATES[0], DATES[0]])
    assert res.dates == [DATES[0]]
    q = _fresh(spark, landed)
    pipeline.run_dates(spark, q, [DATES[0]])
    assert _sorted_gold(spark, p) == _sorted_gold(spark, q)
    with pytest.raises(ValueError):
        pipeline.run_dates(spark, p, ["2024-1-3x"])


def test_streaming_ingest_keeps_running_with_processing_time_trigger(spark, root):
    from daybook.operators import generate
    paths = pipeline.Paths.under(root)
    bronze.write_bronze(generate.generate_events(spark, "2026-01-20", 500), paths.bronze)
    q = ingest.start(spark, paths, available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
        assert mart.mart_view(spark, paths.mart).count() == 1
        bronze.write_bronze(generate.generate_events(spark, "2026-01-21", 500), paths.bronze)
        q.processAllAvailable()
        assert mart.mart_view(spark, paths.mart).count() == 2
        assert q.isActive
    finally:
        q.stop()


def test_mart_as_catalog_table_and_sql_view(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    pipeline.load(spark, p, DATES)
    name = mart.create_table(spark, p.mart, "mart_test_store")
    try:
        view = mart.create_dashboard_view(spark, name, "daily_metrics_sql")
        got = sorted(spark.sql(f"SELECT * FROM {view}").collect())
        assert got == sorted(mart.mart_view(spark, p.mart).collect())
        # A date cleared by a later load disappears after a refresh.
        pipeline.load(spark, pipeline.Paths(p.bronze, p.silver, p.gold + "-none", p.mart),
                      [DATES[0]])
        mart.refresh_table(spark, name)
        left = pipeline.gold_for(spark, p, DATES[1:]).count()
        assert spark.sql(f"SELECT COUNT(*) FROM {view}").first()[0] == left
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_gold_and_mart_hold_one_file_per_date(spark, landed):
    from daybook.sources import fs, layers
    p = _fresh(spark, landed)
    dates = warehouse.bronze_dates(spark, landed.bronze)
    pipeline.run_dates(spark, p, dates)
    pipeline.load(spark, p, dates)
    for root in (p.gold, p.mart):
        counts = {len(fs.data_files(spark, f)) for d in dates
                  for f in layers.date_folders(spark, root, d)}
        assert counts == {1}, root
    plan = mart.mart_rows_from_gold(pipeline.gold_for(spark, p))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange" not in plan


def test_cli_explain_prints_plans(spark, landed, capsys):
    from daybook.__main__ import main
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    out = main(["explain", "--root", p.silver.rsplit("/silver", 1)[0],
                "--bronze-root", landed.bronze, "--start", DATES[0], "--end", DATES[-1]])
    assert out["dates"] == DATES
    printed = capsys.readouterr().out
    assert "Physical Plan" in printed and "HashAggregate" in printed


def test_cli_ingest_runs_are_incremental(spark, root):
    from daybook.__main__ import main
    from daybook.operators import generate
    paths = pipeline.Paths.under(root)
    bronze.write_bronze(generate.generate_events(spark, "2026-01-25", 800), paths.bronze)
    first = main(["ingest", "--root", root])
    assert first["new_files"] >= 1 and mart.mart_view(spark, paths.mart).count() == 1
    again = main(["ingest", "--root", root])  # nothing new landed
    assert again["new_files"] == 0 and again["batches"] == 0


def test_cli_run_defaults_to_yesterday(spark, root):
    import datetime as dt
    from daybook.__main__ import main
    yesterday = (dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)).isoformat()
    out = main(["run", "--root", root, "--generate", "500"])
    assert out["date"] == yesterday and out["mart_rows"] == 1


def test_concurrent_runs_restore_session_settings(spark, landed):
    from concurrent.futures import ThreadPoolExecutor
    before = {k: spark.conf.get(k, None) for k in
              ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
               "spark.sql.files.minPartitionNum"]}
    targets = [_fresh(spark, landed) for _ in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda p: pipeline.run_dates(spark, p, DATES), targets))
    after = {k: spark.conf.get(k, None) for k in before}
    assert after == before
    assert len({tuple(_sorted_gold(spark, p)) for p in targets}) == 1


def test_report_lists_requested_dates_without_bronze(spark, landed):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES[:1])
    rep = {(r.process_date.isoformat(), r.check): r
           for r in pipeline.quality_report(spark, p, [DATES[0], "2023-12-31"]).collect()}
    assert rep[("2023-12-31", "bronze_rows")].observed == 0
    assert rep[("2023-12-31", "bronze_rows")].passed is False
    assert rep[(DATES[0], "bronze_rows")].passed is True
    assert len(rep) == 2 * 17


def test_report_keeps_dates_whose_bronze_is_gone(spark, landed):
    from daybook.sources import fs
    p = pipeline.Paths.under(scratch_dir(spark, "gone"))
    warehouse.write_fixture_bronze(spark, SF_SMALL, p.bronze)
    pipeline.run_dates(spark, p, DATES)
    pipeline.load(spark, p, DATES)
    fs.delete(spark, bronze.date_path(p.bronze, DATES[1]))
    rep = {(r.process_date.isoformat(), r.check): r
           for r in pipeline.quality_report(spark, p).collect()}
    assert rep[(DATES[1], "bronze_rows")].observed == 0
    assert rep[(DATES[1], "silver_rows")].observed > 0
    assert rep[(DATES[1], "rows_reconciled")].passed is False


def test_no_check_is_blind_on_the_fixture(spark):
    """Every check of the report, and every count of the others, is above zero somewhere."""
    import __spark_entry__ as E
    q = E.queries()
    seen = {}
    for r in q["dq_report"](spark, SF_SMALL).collect():
        seen[r.check] = seen.get(r.check, 0) + abs(r.observed)
    assert len(seen) == 17 and all(seen.values()), seen
    assert all(r.failures for r in q["dq_cast_failures"](spark, SF_SMALL).collect())
    assert all(r.failures for r in q["dq_numeric"](spark, SF_SMALL).collect())
    assert any(r.duplicate_rows for r in q["dq_duplicate_ids"](spark, SF_SMALL).collect())
    assert any(r.spilled_rows for r in q["dq_date_spill"](spark, SF_SMALL).collect())


def test_planning_many_dates_is_one_scan(spark, root):
    from conftest import write_csv
    p = pipeline.Paths.under(root)
    dates = pipeline.date_range("2025-01-01", "2025-04-10")
    for d in dates:
        write_csv(bronze.date_path(p.bronze, d), "a.csv",
                  "event_id,user_id,event_type,product_id,event_timestamp,amount\n"
                  f"a,1,view,8,{d}T01:00:00,0.0\n")
    plan = pipeline.silver_plan(spark, p, dates)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan and "Union" not in plan
    plan = pipeline.silver_plan(spark, p, dates, rebalance=True)
    assert "REBALANCE" in plan._jdf.queryExecution().executedPlan().toString()


def test_jdbc_load_keeps_the_old_date_when_it_fails(spark, landed, tmp_path):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    url = f"jdbc:derby:{tmp_path}/mart_fail;create=true"
    gold = pipeline.gold_for(spark, p, DATES)
    n = jdbc.load_mart_jdbc(spark, gold, url, DATES)
    bad = gold.withColumn("daily_active_users", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception):
        jdbc.load_mart_jdbc(spark, bad, url, DATES)
    assert jdbc.read_mart_jdbc(spark, url).count() == n
    tables = spark.read.jdbc(url, "SYS.SYSTABLES").where("TABLETYPE = 'T'").select("TABLENAME")
    assert [r[0] for r in tables.collect()] == ["daily_metrics"]  # no staging table is left


def test_jdbc_table_of_another_case_or_without_arrival_dates(spark, landed, tmp_path):
    p = _fresh(spark, landed)
    pipeline.run_dates(spark, p, DATES)
    url = f"jdbc:derby:{tmp_path}/mart_old;create=true"
    gold = pipeline.gold_for(spark, p, DATES)
    conn = jdbc._connect(spark, url, {})
    try:
        stmt = conn.createStatement()
        stmt.executeUpdate("CREATE TABLE DAILY_METRICS (x INT)")
        cols = ", ".join(f'"{c}" {jdbc.DDL_TYPES[c]}' for c in jdbc.STORED[1:])
        stmt.executeUpdate(f'CREATE TABLE "daily_metrics" ({cols})')
        stmt.executeUpdate(f"""INSERT INTO "daily_metrics" ("metric_date", "daily_active_users")
                               VALUES (DATE('{DATES[0]}'), 1), (DATE('2020-01-01'), 2)""")
    finally:
        conn.close()
    n = jdbc.load_mart_jdbc(spark, gold, url, DATES)
    assert jdbc.read_mart_jdbc(spark, url).count() == n + 1  # the old row of a loaded date went


def test_cli_single_steps_and_jdbc(spark, landed, tmp_path):
    from daybook.__main__ import main
    p = _fresh(spark, landed)
    at = ["--root", p.silver.rsplit("/silver", 1)[0], "--bronze-root", landed.bronze,
          "--process-date", DATES[0]]
    assert main(["check-bronze", *at])["files"] >= 1
    assert main(["transform", *at])["dates"] == [DATES[0]]
    assert main(["check-layers", *at])["gold"] >= 1
    url = f"jdbc:derby:{tmp_path}/mart_cli;create=true"
    main(["load", *at, "--jdbc-url", url])
    assert main(["check-mart", *at])["mart_rows"] == 1
    assert sorted(jdbc.read_mart_jdbc(spark, url).collect()) == \
        sorted(mart.mart_view(spark, p.mart).collect())
