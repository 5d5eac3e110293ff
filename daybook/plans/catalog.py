"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the given ``events`` table through the Bronze fixture mapping,
either directly as a DataFrame plan or through the warehouse that writes it as
Bronze CSV and runs the pipeline over all of it. Column names match the oracle
SQL of the same key (``daybook.oracle``).
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import dashboard, generate, gold, quality, silver
from daybook.plans import fixture, pipeline, warehouse
from daybook.schema import (BRONZE_COLUMNS, GOLD_COLUMNS, MART_COLUMNS, SILVER_COLUMNS,
                            SILVER_SCHEMA)
from daybook.session import configure, scratch_dir
from daybook.sources import bronze, file_index, headers, layers, mart, versions

GOLD_KEYS = pipeline.GOLD_KEYS

# The arrival date the single-date keys ask for, and the preview size.
FIXED_DATE = "2024-01-12"
PREVIEW_ROWS = 3
# The dates whose Silver dq_report damages.
DROPPED_DATE = "2024-01-20"
NULLED_DATE = "2024-01-21"


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return silver.transform_to_silver(fixture.bronze(spark, sf_dir))


def _silver_out(df: DataFrame) -> DataFrame:
    # Timestamps leave as wall-clock values (timestamp_ntz) for engine-neutral compare.
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "event_timestamp"
                       else F.col(c) for c in SILVER_COLUMNS])


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return mart.mart_view(spark, paths.mart)


# --- Silver and Gold as plans over the table -------------------------------------------

def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_out(_silver(spark, sf_dir))


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_totals(_silver(spark, sf_dir))


def product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.product_revenue(_silver(spark, sf_dir))


def top_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_product(gold.product_revenue_exact(_silver(spark, sf_dir)))


def top_product_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_product_max_by(gold.product_revenue_exact(_silver(spark, sf_dir)))


def gold_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.aggregate_to_gold(_silver(spark, sf_dir), GOLD_KEYS)


# --- Files: Bronze CSV, Silver/Gold Parquet ----------------------------------------------

def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return bronze.read_bronze(spark, paths.bronze).select(*BRONZE_COLUMNS)


def silver_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return _silver_out(pipeline.silver_for(spark, paths, [FIXED_DATE]))


def gold_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run of one arrival date into fresh Silver/Gold folders."""
    paths, _ = warehouse.fresh_layers(spark, sf_dir)
    pipeline.daily_run(spark, paths, FIXED_DATE)
    return pipeline.gold_for(spark, paths, [FIXED_DATE]).select(*GOLD_COLUMNS)


def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    rows = layers.read_layout(spark, paths.silver, SILVER_SCHEMA)
    return rows.groupBy("process_date", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"))


def backfill_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All arrival dates in one job per layer, into fresh folders."""
    paths, dates = warehouse.fresh_layers(spark, sf_dir)
    pipeline.backfill(spark, paths, min(dates), max(dates))
    return pipeline.gold_for(spark, paths).select(*GOLD_COLUMNS)


# --- Mart -----------------------------------------------------------------------------------

def mart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir)


def mart_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every date twice into a fresh mart: the second load replaces the first."""
    base, dates = warehouse.build(spark, sf_dir)
    paths, _ = warehouse.fresh_layers(spark, sf_dir)
    target = pipeline.Paths(bronze=base.bronze, silver=base.silver, gold=base.gold,
                            mart=paths.mart)
    pipeline.load(spark, target, dates)
    pipeline.load(spark, target, dates)
    return mart.mart_view(spark, target.mart)


def dashboard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.table(_mart(spark, sf_dir))


def mart_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.by_date(_mart(spark, sf_dir), FIXED_DATE)


def mart_count_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.count_by_date(_mart(spark, sf_dir), FIXED_DATE)


def mart_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.summary(_mart(spark, sf_dir))


def mart_revenue_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.revenue_rounded(_mart(spark, sf_dir), FIXED_DATE)


def mart_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.preview(_mart(spark, sf_dir), PREVIEW_ROWS)


def kpi_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.latest(_mart(spark, sf_dir))


def dau_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.series(_mart(spark, sf_dir), "daily_active_users")


def revenue_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.series(_mart(spark, sf_dir), "total_revenue")


def mart_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart through its catalog table, created twice: the second time changes nothing."""
    paths, _ = warehouse.build(spark, sf_dir)
    name = f"mart_{uuid.uuid4().hex[:12]}"
    try:
        mart.create_table(spark, paths.mart, name)
        mart.create_table(spark, paths.mart, name)
        rows = spark.table(name).select(F.make_date("year", "month", "day").alias("process_date"),
                                        *MART_COLUMNS)
        return rows.checkpoint()  # the table is dropped before the caller reads
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def mart_load_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every date into a fresh mart; is each row's load time within that load?"""
    base, dates = warehouse.build(spark, sf_dir)
    paths, _ = warehouse.fresh_layers(spark, sf_dir)
    target = pipeline.Paths(bronze=base.bronze, silver=base.silver, gold=base.gold,
                            mart=paths.mart)

    def now():
        return spark.sql("SELECT current_timestamp() AS t").head()["t"]

    before = now()
    pipeline.load(spark, target, dates)
    after = now()
    return mart.read_mart(spark, target.mart).select(
        "process_date", "metric_date",
        F.col("created_at").between(F.lit(before), F.lit(after)).alias("loaded_in_run"))


def empty_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page over a loaded mart, and after every date was loaded again without Gold."""
    base, dates = warehouse.build(spark, sf_dir)
    paths, _ = warehouse.fresh_layers(spark, sf_dir)
    target = pipeline.Paths(bronze=base.bronze, silver=base.silver, gold=base.gold,
                            mart=paths.mart)
    states = None
    for state, gold_root in (("loaded", base.gold), ("cleared", paths.gold)):
        pipeline.load(spark, replace(target, gold=gold_root), dates)
        # the view follows the commit it was made at, so the next load does not change it
        found = dashboard.status(mart.mart_view(spark, target.mart)).select(
            F.lit(state).alias("state"), "row_count",
            (F.col("message") == dashboard.EMPTY_MESSAGE).alias("message_shown"))
        found = found.fillna(False, ["message_shown"])
        states = found if states is None else states.unionByName(found)
    return states


# --- Metric dates over all arrivals, late files, commits -----------------------------------

def _metric_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return pipeline.metric_dates(spark, paths)


def metric_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each metric date over all arrivals, merged from the stored parts."""
    return _metric_dates(spark, sf_dir)


def metric_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.latest(_metric_dates(spark, sf_dir))


def metric_dau_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.series(_metric_dates(spark, sf_dir), "daily_active_users")


def metric_revenue_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.series(_metric_dates(spark, sf_dir), "total_revenue")


def late_files_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after every date's files came in two deliveries, the second taken in as late files."""
    paths = pipeline.Paths.under(scratch_dir(spark, "late"))
    raw, late = fixture.raw(spark, sf_dir), F.xxhash64("event_id", "user_id") % 5 == 0
    bronze.write_bronze(raw.where(~late), paths.bronze, mixed_dates=True)
    dates = warehouse.bronze_dates(spark, paths.bronze)
    pipeline.run_dates(spark, paths, dates)
    bronze.add_files(raw.where(late), paths.bronze)
    pipeline.apply_late_files(spark, paths)
    return pipeline.gold_for(spark, paths).select(*GOLD_COLUMNS)


def lost_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader of the mart finds after a load whose commit record was cut off, and after
    the load was done again: (state, metric_date, process_date, total_revenue)."""
    base, dates = warehouse.build(spark, sf_dir)
    paths, _ = warehouse.fresh_layers(spark, sf_dir)
    target = replace(paths, silver=base.silver, gold=base.gold)
    pipeline.load(spark, target, dates)
    changed = pipeline.gold_for(spark, base, dates).withColumn("total_revenue", F.lit(-1.0))
    rows = mart.mart_rows_from_gold(changed)
    versions.lose_commit(spark, target.mart, layers.write_version(rows, target.mart))
    states = [("lost", mart.read_mart(spark, target.mart))]
    layers.replace_dates(spark, rows, target.mart, dates)
    states.append(("done again", mart.read_mart(spark, target.mart)))
    columns = ["process_date", "metric_date", "total_revenue"]
    return reduce(DataFrame.unionByName,
                  [df.select(F.lit(state).alias("state"), *columns) for state, df in states])


def resumed_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of a backfill that stopped after Silver and was resumed."""
    paths, dates = warehouse.fresh_layers(spark, sf_dir)
    pipeline.run_silver(spark, paths, dates)
    pipeline.backfill(spark, paths, min(dates), max(dates), resume=True)
    return pipeline.gold_for(spark, paths).select(*GOLD_COLUMNS)


# --- Gates ----------------------------------------------------------------------------------

def bronze_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by arrival date, read from the files that the listing names."""
    paths, dates = warehouse.build(spark, sf_dir)
    rows = bronze.read_bronze(spark, paths.bronze).select(
        "process_date", F.col("_metadata.file_path").alias("path"))
    # listed paths come as file:/..., scanned ones as file:///...
    one = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("listed")
    listed = bronze.bronze_files(spark, paths.bronze, dates).select(one)
    return (rows.groupBy("process_date", one).count().join(listed, "listed")
            .groupBy("process_date").agg(F.sum("count").cast("bigint").alias("row_count")))


def bronze_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Bronze gate for every day from before the first to after the last arrival date."""
    paths, dates = warehouse.build(spark, sf_dir)
    day = datetime.timedelta(days=1)
    return file_index.present(
        file_index.known_files(spark, paths.files),
        (datetime.date.fromisoformat(min(dates)) - day).isoformat(),
        (datetime.date.fromisoformat(max(dates)) + day).isoformat())


def _odd_headers(spark: SparkSession, sf_dir: str) -> pipeline.Paths:
    """Bronze of the given events whose files have other headers on some days of the month."""
    paths = pipeline.Paths.under(scratch_dir(spark, "headers"))
    raw, day = fixture.raw(spark, sf_dir), F.dayofmonth("process_date") % 7
    kinds = {0: BRONZE_COLUMNS[::-1], 3: [*BRONZE_COLUMNS, "source"],
             5: [c for c in BRONZE_COLUMNS if c != "event_type"]}
    bronze.write_bronze(raw.where(~day.isin(*kinds)), paths.bronze, mixed_dates=True)
    for k, columns in kinds.items():
        rows = raw.where(day == k).withColumn("source", F.lit("app"))
        bronze.add_files(rows, paths.bronze, columns)
    return paths


def header_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every Bronze file's header against the declared columns, one row a date and header."""
    found = pipeline.header_report(spark, _odd_headers(spark, sf_dir))
    lists = [F.array_join(c, ",").alias(c) for c in ("header", "missing", "extra")]
    return found.select("process_date", *lists, "reordered", "passed").distinct()


def bronze_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of files with their columns in any order, or one missing or too many."""
    paths = _odd_headers(spark, sf_dir)
    return headers.read_by_name(spark, paths.bronze).select("process_date", *BRONZE_COLUMNS)


def gate_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gated run of a date, and of one without Bronze: rows of each step that was done."""
    paths, dates = warehouse.fresh_layers(spark, sf_dir)
    after = (datetime.date.fromisoformat(max(dates)) + datetime.timedelta(days=1)).isoformat()
    rows = []
    for date in (FIXED_DATE, after):
        steps: dict = {}
        at = datetime.date.fromisoformat(date)
        try:
            pipeline.run_gated(spark, paths, date, steps=steps)
            rows += [(at, "1 silver", steps["layers"]["silver"]),
                     (at, "2 gold", steps["layers"]["gold"]), (at, "3 mart", steps["mart_rows"])]
        except bronze.MissingBronzeError:
            rows.append((at, "0 stopped", len(steps)))
    return spark.createDataFrame(rows, "process_date date, step string, row_count long")


def idempotency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates run and loaded twice: rows by layer and date, and whether they stayed the same."""
    paths, dates = warehouse.fresh_layers(spark, sf_dir)
    pipeline.run_dates(spark, paths, dates)
    pipeline.load(spark, paths, dates)
    return pipeline.rerun_report(spark, paths, dates)


# --- Quality --------------------------------------------------------------------------------

def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return (paths, bronze.read_bronze(spark, paths.bronze),
            pipeline.silver_for(spark, paths, None), pipeline.gold_for(spark, paths))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, b, s, g = _layers(spark, sf_dir)
    m = mart.mart_view(spark, paths.mart).withColumnRenamed("metric_date", "process_date")
    return quality.layer_counts({"bronze": b, "silver": s, "gold": g, "mart": m})


def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return quality.null_counts(bronze.read_bronze(spark, paths.bronze))


def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, b, s, g = _layers(spark, sf_dir)
    return quality.reconcile(b, s, g)


def dq_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return quality.numeric_validity(bronze.read_bronze(spark, paths.bronze))


def dq_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return quality.cast_failures(bronze.read_bronze_checked(spark, paths.bronze))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check per arrival date in one report, over a damaged Silver.

    A sound run leaves no Silver date out and no key NULL, so those checks could not
    fail: here Silver lacks one date, and has NULL users on another.
    """
    paths, _ = warehouse.build(spark, sf_dir)
    day, user = F.col("process_date").cast("string"), F.col("user_id")
    no_user = (day == NULLED_DATE) & (F.col("product_id") % 2 == 0)
    damaged = (pipeline.silver_for(spark, paths, None).where(day != DROPPED_DATE)
               .withColumn("user_id", F.when(~no_user, user)))
    return quality.report(bronze.read_bronze_checked(spark, paths.bronze), damaged,
                          pipeline.gold_for(spark, paths), mart.mart_view(spark, paths.mart))


def dq_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return quality.duplicate_ids(pipeline.silver_for(spark, paths, None))


def dq_date_spill(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = warehouse.build(spark, sf_dir)
    return quality.date_spill(pipeline.silver_for(spark, paths, None))


# --- Event source ---------------------------------------------------------------------------

def gen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic event per row of the given events table, on the fixed date."""
    configure(spark)
    ids = fixture.read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return generate.events_for_ids(ids, FIXED_DATE).select(*BRONZE_COLUMNS)


_QUERIES = {
    "bronze_scan": bronze_scan,
    "silver_clean": silver_clean,
    "silver_by_date": silver_by_date,
    "gold_by_date": gold_by_date,
    "partition_columns": partition_columns,
    "daily_totals": daily_totals,
    "product_revenue": product_revenue,
    "top_product": top_product,
    "top_product_max_by": top_product_max_by,
    "gold_daily_metrics": gold_daily_metrics,
    "backfill_gold": backfill_gold,
    "mart_rows": mart_rows,
    "mart_replace": mart_replace,
    "dashboard_table": dashboard_table,
    "mart_by_date": mart_by_date,
    "mart_count_by_date": mart_count_by_date,
    "mart_summary": mart_summary,
    "mart_revenue_rounded": mart_revenue_rounded,
    "mart_preview": mart_preview,
    "kpi_latest": kpi_latest,
    "dau_series": dau_series,
    "revenue_series": revenue_series,
    "layer_counts": layer_counts,
    "dq_null_counts": dq_null_counts,
    "dq_reconcile": dq_reconcile,
    "dq_numeric": dq_numeric,
    "dq_cast_failures": dq_cast_failures,
    "dq_duplicate_ids": dq_duplicate_ids,
    "dq_report": dq_report,
    "dq_date_spill": dq_date_spill,
    "gen_events": gen_events,
    "mart_catalog": mart_catalog,
    "mart_load_time": mart_load_time,
    "empty_mart": empty_mart,
    "bronze_listing": bronze_listing,
    "bronze_present": bronze_present,
    "gate_order": gate_order,
    "idempotency": idempotency,
    "metric_dates": metric_dates,
    "metric_kpi": metric_kpi,
    "metric_dau_series": metric_dau_series,
    "metric_revenue_series": metric_revenue_series,
    "late_files_gold": late_files_gold,
    "lost_commit": lost_commit,
    "resumed_backfill": resumed_backfill,
    "header_report": header_report,
    "bronze_by_name": bronze_by_name,
}


def queries():
    return dict(_QUERIES)
