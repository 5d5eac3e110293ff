"""Plan-shape regressions: the properties the design relies on at scale."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from daybook.operators import gold, silver
from daybook.plans import fixture, pipeline, warehouse
from daybook.sources import bronze
from tools.plan_report import BAD, summarise


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse.build(spark, SF_SMALL)


def test_silver_write_has_no_shuffle(spark, wh):
    paths, dates = wh
    cleaned = silver.transform_to_silver(bronze.read_bronze(spark, paths.bronze, dates[:3]))
    plan = _plan(cleaned)
    assert "Exchange" not in plan
    assert "FileScan csv" in plan


def test_gold_shuffles_only_preaggregated_rows(spark, wh):
    paths, dates = wh
    g = gold.aggregate_to_gold(pipeline.silver_for(spark, paths, dates), pipeline.GOLD_KEYS)
    plan = _plan(g)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # Distinct users: (keys, user), then (keys). Revenue: (keys, product, bin) over Silver rows,
    # then (keys, product) and (keys) for the top product, (keys, bin) and (keys) for the total.
    # The plan lists (keys, product, bin) for both; it runs once (a reused exchange).
    assert len(exchanges) == 8 and sum("_groupingexpression" in e and "product_id" in e for e in exchanges) == 2
    assert any("user_id" in e for e in exchanges) and any("product_id" in e for e in exchanges)
    # Every exchange over scan rows is fed by a partial aggregate.
    for block in re.split(r"Exchange hashpartitioning", plan)[1:]:
        assert re.search(r"HashAggregate|SortAggregate", block.split("Exchange")[0])
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(len(s.split(",")) <= 3 for s in schemas)


def test_parts_are_aggregated_before_their_only_shuffle(spark, wh):
    paths, dates = wh
    for df in pipeline.parts_plans(pipeline.silver_for(spark, paths, dates)):
        plan = _plan(df)
        keyed = re.findall(r"Exchange hashpartitioning\(([^)]*)\), ENSURE", plan)
        assert len(keyed) == 1 and "process_date" in keyed[0]
        below = plan.split("ENSURE_REQUIREMENTS")[-1]
        assert "partial_" in below and "user_id" not in keyed[0]


def test_metric_dates_read_no_silver(spark, wh):
    files = pipeline.metric_dates(spark, wh[0]).inputFiles()
    assert files and {f.split("_parts/")[1].split("/")[0] for f in files} == {"users", "revenue"}


def test_single_date_read_lists_one_partition(spark, wh):
    paths, dates = wh
    plan = _plan(pipeline.silver_for(spark, paths, [dates[0]]))
    assert "InMemoryFileIndex(1 paths)" in plan or "1 paths" in plan


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_unscalable_operators(spark, key):
    s = summarise(E.queries()[key](spark, SF_SMALL))
    assert s["bad"] == [], f"{key}: {s['bad']} (checked: {BAD})"


def test_row_number_top1_is_limited_before_the_shuffle(spark):
    plan = _plan(E.queries()["top_product"](spark, SF_SMALL))
    # Partial limit below the exchange on the date, final limit above it.
    below = plan.split("Exchange hashpartitioning(event_date")[1]
    assert "WindowGroupLimit" in below.split("Exchange")[0] and "Partial" in below
    assert "Final" in plan.split("Exchange hashpartitioning(event_date")[0]


def test_backfill_of_small_dates_writes_bounded_silver_files(spark, root):
    """One scan, no shuffle: no more Silver files than Bronze has; rebalanced: fewer."""
    from daybook.operators import generate
    from daybook.sources import fs, layers
    paths = pipeline.Paths.under(root)
    dates = [f"2026-06-{d:02d}" for d in range(1, 7)]
    for d in dates:
        bronze.write_bronze(generate.generate_events(spark, d, 4_000, partitions=4),
                            paths.bronze)
    pipeline.run_dates(spark, paths, dates)

    def files():
        return [len(fs.data_files(spark, f)) for d in dates
                for f in layers.date_folders(spark, paths.silver, d)]

    assert max(files()) <= 4
    before = pipeline.silver_for(spark, paths, dates).count()
    pipeline.run_dates(spark, paths, dates, rebalance=True)
    assert max(files()) <= 2 and pipeline.silver_for(spark, paths, dates).count() == before


def test_landing_mixed_dates_writes_few_files(spark, root):
    from daybook.sources import fs
    bronze.write_bronze(fixture.raw(spark, SF_SMALL).repartition(16), root, mixed_dates=True)
    names = fs.subdirs(spark, root)
    assert len(names) == 30
    assert max(len(fs.data_files(spark, f"{root}/{n}")) for n in names) <= 3


def test_quality_report_parses_bronze_csv_once(spark):
    plan = _plan(E.queries()["dq_report"](spark, SF_SMALL))
    assert plan.count("FileScan csv") == 1
