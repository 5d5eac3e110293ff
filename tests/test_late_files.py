"""Late files, metric dates over all arrivals, the file index, resumed runs, stored digests."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import write_csv
from daybook.operators import parts
from daybook.plans import pipeline
from daybook.schema import GOLD_COLUMNS
from daybook.session import local_path, scratch_dir
from daybook.sources import bronze, file_index, layers, mart, versions

HEADER = "event_id,user_id,event_type,product_id,event_timestamp,amount\n"
DATES = ["2026-05-01", "2026-05-02", "2026-05-03"]


def land(paths, date, name, rows):
    """rows: (event id, user, product, event date, amount)"""
    lines = [f"{e},{u},purchase,{p},{day}T01:00:00,{x}\n" for e, u, p, day, x in rows]
    write_csv(bronze.date_path(paths.bronze, date), f"{name}.csv", HEADER + "".join(lines))


def some_rows(seed, date, n=30):
    """Events of the date and the day before, users -40000 to 40000 in few and many buckets."""
    rng = random.Random(seed)
    day = dt.date.fromisoformat(date)
    return [(f"{seed}-{i}", rng.choice([rng.randint(1, 9), rng.randint(-40_000, 40_000), 2**31 - 1, -2**31]),
             rng.randint(1, 4), day - dt.timedelta(days=rng.choice([0, 0, 1])),
             rng.choice([1e25, 1e-9, rng.randint(0, 900) / 100])) for i in range(n)]


def landed(spark, deliveries=(1, 2)):
    paths = pipeline.Paths.under(scratch_dir(spark, "late"))
    for i, d in enumerate(DATES):
        for k in deliveries:
            land(paths, d, f"f{k}", some_rows(10 * i + k, d))
    return paths


def gold_of(spark, paths):
    return sorted(tuple(r) for r in pipeline.gold_for(spark, paths).select(*GOLD_COLUMNS).collect())


def fresh(spark, paths):
    return pipeline.Paths.under(scratch_dir(spark, "whole"), bronze_root=paths.bronze)


def test_late_file_changes_only_its_part(spark):
    paths = landed(spark)
    pipeline.run_dates(spark, paths, DATES)
    tables = (paths.silver, paths.revenue_parts, paths.user_parts)
    before = {t: versions.read_state(spark, t).dates for t in tables}
    land(paths, DATES[1], "late", some_rows(99, DATES[1]))
    result = pipeline.apply_late_files(spark, paths)
    assert result.dates == [DATES[1]]
    for t in tables:
        after = versions.read_state(spark, t).dates
        assert after[DATES[0]] == before[t][DATES[0]] and after[DATES[2]] == before[t][DATES[2]]
        assert after[DATES[1]].folders[:1] == before[t][DATES[1]].folders
        assert len(after[DATES[1]].folders) == 2  # the old part stayed, one was added
    whole = fresh(spark, paths)
    pipeline.run_dates(spark, whole, DATES)
    assert gold_of(spark, paths) == gold_of(spark, whole)
    assert pipeline.silver_for(spark, paths, None).count() == pipeline.silver_for(spark, whole, None).count()
    pipeline.apply_late_files(spark, paths)  # nothing new: nothing is written
    assert versions.read_state(spark, paths.silver).dates[DATES[1]].folders == \
        versions.read_state(spark, paths.silver).dates[DATES[1]].folders
    assert pipeline.apply_late_files(spark, paths).dates == []


def test_late_files_without_good_rows_new_dates_and_changed_files(spark):
    paths = landed(spark)
    pipeline.run_dates(spark, paths, DATES[:2])
    write_csv(bronze.date_path(paths.bronze, DATES[0]), "bad.csv", HEADER + "x,,view,1,garbage,1\n")
    land(paths, DATES[1], "f1", some_rows(77, DATES[1], 12))  # a known file delivered again
    result = pipeline.apply_late_files(spark, paths)
    assert sorted(result.dates) == DATES  # the third was not run yet
    whole = fresh(spark, paths)
    pipeline.run_dates(spark, whole, DATES)
    assert gold_of(spark, paths) == gold_of(spark, whole)
    assert pipeline.apply_late_files(spark, paths).dates == []


@pytest.mark.parametrize("stop_at", [1, 2, 3, 4, 5])
def test_late_files_after_a_run_that_stopped(spark, monkeypatch, stop_at):
    """A driver lost at any commit of the take-in: doing it again gives the full run's Gold."""
    paths = landed(spark, (1,))
    pipeline.run_dates(spark, paths, DATES)
    land(paths, DATES[0], "late", some_rows(55, DATES[0]))
    calls, real = [], versions.commit

    def lost(*args, **kwargs):
        calls.append(1)
        if len(calls) == stop_at:
            raise RuntimeError("driver lost")
        return real(*args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lost)
        with pytest.raises(RuntimeError):
            pipeline.apply_late_files(spark, paths)
    pipeline.apply_late_files(spark, paths)
    whole = fresh(spark, paths)
    pipeline.run_dates(spark, whole, DATES)
    assert gold_of(spark, paths) == gold_of(spark, whole)


def test_metric_dates_over_all_arrivals(spark):
    paths = landed(spark)
    pipeline.run_dates(spark, paths, DATES)
    silver = pipeline.silver_for(spark, paths, None)
    want = {r["event_date"]: r["n"] for r in silver.groupBy("event_date").agg(
        F.count_distinct("user_id").alias("n")).collect()}
    got = pipeline.metric_dates(spark, paths).collect()
    assert {r["metric_date"]: r["daily_active_users"] for r in got} == want and len(got) == 4
    from daybook.operators import gold
    one = gold.aggregate_to_gold(silver).withColumnRenamed("event_date", "metric_date")
    assert sorted(map(tuple, got)) == sorted(map(tuple, one.collect()))
    assert pipeline.metric_dates(spark, pipeline.Paths.under(scratch_dir(spark, "none"))).count() == 0


def test_user_sets_of_any_ints_merge(spark):
    rng = random.Random(2)
    rows = [(f"a{i % 3}", "d", rng.choice([0, -1, 1, 32768, 32769, -32768, -32769, 2**31 - 1, -2**31,
                                           rng.randint(-10**6, 10**6)])) for i in range(900)]
    df = spark.createDataFrame(rows, "process_date string, event_date string, user_id int")
    sets = parts.user_sets(df)
    by_pair = {(r[0], r[1]): r[2] for r in parts.count_users(sets, parts.ARRIVAL_KEYS).collect()}
    assert by_pair == {(a, "d"): len({u for x, _, u in rows if x == a}) for a in ("a0", "a1", "a2")}
    (merged,) = parts.count_users(sets, ["event_date"]).collect()
    assert merged["daily_active_users"] == len({u for _, _, u in rows})


def test_index_lists_and_remembers(spark):
    paths = landed(spark)
    write_csv(bronze.date_path(paths.bronze, "2026-05-09"), "_SUCCESS", "")
    listed = file_index.list_files(spark, paths.bronze)
    assert sorted(r["path"] for r in listed.collect()) == sorted(
        f"date={d}/f{k}.csv" for d in DATES for k in (1, 2))
    assert file_index.delivered(listed).keys() == set(DATES)
    assert file_index.list_files(spark, paths.bronze, ["2026-06-01"]).count() == 0
    assert file_index.list_files(spark, paths.bronze + "/none").count() == 0
    pipeline.run_dates(spark, paths, DATES[:2])
    known = file_index.known_files(spark, paths.files)
    assert file_index.late_files(listed, known).select("process_date").distinct().count() == 1
    days = file_index.present(known, "2026-04-30", "2026-05-03").orderBy("process_date").collect()
    assert [r["present"] for r in days] == [False, True, True, False]


def test_files_that_change_during_a_run_stop_it(spark, monkeypatch):
    paths = landed(spark)
    real = layers.write_version

    def write(df, root, *args):
        out = real(df, root, *args)
        if root == paths.silver:
            land(paths, DATES[0], "meanwhile", some_rows(3, DATES[0]))
        return out

    monkeypatch.setattr(layers, "write_version", write)
    with pytest.raises(pipeline.GateError, match="changed during the run"):
        pipeline.run_dates(spark, paths, DATES)
    assert pipeline.silver_for(spark, paths, None).count() == 0


def test_backfill_goes_on_where_it_stopped(spark, monkeypatch):
    paths = landed(spark)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "_write_parts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pipeline.backfill(spark, paths, DATES[0], DATES[1])
    silver = versions.read_state(spark, paths.silver).dates
    result = pipeline.backfill(spark, paths, DATES[0], DATES[2], resume=True)
    assert result.reused_silver == DATES[:2] and result.reused_gold == []
    after = versions.read_state(spark, paths.silver).dates
    assert all(after[d] == silver[d] for d in DATES[:2])
    again = pipeline.backfill(spark, paths, DATES[0], DATES[2], resume=True)
    assert again.reused_silver == again.reused_gold == DATES
    land(paths, DATES[1], "f1", some_rows(123, DATES[1]))
    changed = pipeline.backfill(spark, paths, DATES[0], DATES[2], resume=True)
    assert changed.reused_silver == changed.reused_gold == [DATES[0], DATES[2]]
    whole = fresh(spark, paths)
    pipeline.run_dates(spark, whole, DATES)
    assert gold_of(spark, paths) == gold_of(spark, whole)


def test_digests_are_those_of_the_written_rows(spark, monkeypatch):
    from daybook.operators import quality
    from daybook.schema import MART_COLUMNS, SILVER_COLUMNS
    monkeypatch.setattr(quality, "OBSERVED_DATES", 2)  # three dates take two observations
    paths = landed(spark)
    pipeline.run_dates(spark, paths, DATES)
    pipeline.load(spark, paths, DATES)
    for root, rows, columns in (
            (paths.silver, pipeline.silver_for(spark, paths, None), SILVER_COLUMNS),
            (paths.gold, pipeline.gold_for(spark, paths), GOLD_COLUMNS[1:]),
            (paths.mart, mart.read_mart(spark, paths.mart), MART_COLUMNS)):
        state = versions.read_state(spark, root)
        table = versions.state_frame(spark, root, state.number)
        want = {r["process_date"]: (r["row_count"], str(r["digest"]))
                for r in quality.layer_digest(rows, columns).collect()}
        assert {r["process_date"]: (r["row_count"], r["digest"]) for r in table.collect()} == want
        assert len(want) == 3


def test_idempotency_reads_no_silver(spark, monkeypatch):
    paths = landed(spark)
    pipeline.run_dates(spark, paths, DATES)
    pipeline.load(spark, paths, DATES)
    report = pipeline.rerun_report(spark, paths, DATES)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "user_id" not in plan and "Relation" in plan and local_path(paths.silver)
    assert {r["unchanged"] for r in report.collect()} == {True}
    assert report.count() == 9
