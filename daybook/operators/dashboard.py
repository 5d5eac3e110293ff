"""Dashboard queries over the mart view (D1–D5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schema import MART_COLUMNS


def _order(descending: bool = False) -> list:
    """By date, in either direction; of a date's rows the one with most users comes first.

    A date has several rows when late events of it arrived on other dates. Revenue, then
    the smaller product id, settle equal user counts.
    """
    date = F.col("metric_date")
    return [date.desc() if descending else date.asc(), F.col("daily_active_users").desc(),
            F.col("total_revenue").desc_nulls_last(), F.col("top_product_id").asc_nulls_last()]


# What the page says instead of cards and charts while the mart has no row.
EMPTY_MESSAGE = "The mart holds no metrics so far."


def table(mart: DataFrame) -> DataFrame:
    """The whole mart, ordered by date."""
    return mart.select(*MART_COLUMNS).orderBy(*_order())


def latest(mart: DataFrame) -> DataFrame:
    """KPI cards: the latest date's users, revenue and top product revenue (NULL → 0.0).

    Of several rows of that date it is the one with most users. A top-1
    (TakeOrderedAndProject): each task keeps its best row, no full sort.
    """
    return (mart.orderBy(*_order(descending=True)).limit(1)
            .select("metric_date",
                    F.col("daily_active_users").cast("int").alias("daily_active_users"),
                    F.col("total_revenue").cast("double").alias("total_revenue"),
                    F.coalesce(F.col("top_product_revenue").cast("double"), F.lit(0.0))
                    .alias("top_product_revenue")))


def series(mart: DataFrame, value: str) -> DataFrame:
    """A chart series: (metric_date, value) ordered by date."""
    return mart.orderBy(*_order()).select("metric_date", value)


def preview(mart: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by date (ordered, so the answer is defined)."""
    return mart.select(*MART_COLUMNS).orderBy(*_order()).limit(n)


def by_date(mart: DataFrame, date: str) -> DataFrame:
    """The rows of one metric date, whichever arrival date brought them."""
    return mart.where(F.col("metric_date") == F.lit(date).cast("date")).select(*MART_COLUMNS)


def count_by_date(mart: DataFrame, date: str) -> DataFrame:
    """(row_count): rows of one metric date."""
    return mart.where(F.col("metric_date") == F.lit(date).cast("date")) \
        .agg(F.count(F.lit(1)).alias("row_count"))


def summary(mart: DataFrame) -> DataFrame:
    """(row_count, dau_sum) over the whole mart view."""
    return mart.agg(F.count(F.lit(1)).alias("row_count"),
                    F.sum("daily_active_users").cast("bigint").alias("dau_sum"))


def revenue_rounded(mart: DataFrame, date: str) -> DataFrame:
    """Revenue rounded to cents (exact decimal rounding, then double)."""
    rounded = F.round(F.col("total_revenue").cast("decimal(38,6)"), 2).cast("double")
    return by_date(mart, date).select("metric_date", "daily_active_users",
                                      rounded.alias("revenue"), "top_product_id")


def status(mart: DataFrame) -> DataFrame:
    """(row_count, message): what the page has to show, or the message if that is nothing."""
    count = F.count(F.lit(1))
    return mart.agg(count.alias("row_count"), F.when(count == 0, F.lit(EMPTY_MESSAGE)).alias("message"))


def page(mart: DataFrame) -> dict:
    """Everything the dashboard page shows, from one read of the mart.

    The mart view has a row per date and late arrival, so it is cached for the page
    (bounded by the number of dates) and released afterwards. The ordered table also gives
    both series; the KPI row is the latest date with NULL top revenue as 0.0.
    """
    view = mart.select(*MART_COLUMNS).cache()
    try:
        message = status(view).first()["message"]
        if message:
            return {"message": message, "kpi": None, "table": []}
        rows = table(view).collect()
        return {"message": None, "kpi": latest(view).first().asDict(), "table": rows,
                "dau_series": [(r.metric_date, r.daily_active_users) for r in rows],
                "revenue_series": [(r.metric_date, r.total_revenue) for r in rows]}
    finally:
        view.unpersist()


# The SQL statements the dashboard and the manual checks run against
# the metrics table. They must run unchanged against the view registered by
# register_view (the rounding check is in Spark SQL's cast syntax).
VIEW_NAME = "daily_metrics"
DASHBOARD_SQL = f"SELECT {', '.join(MART_COLUMNS)} FROM daily_metrics ORDER BY metric_date"
COUNT_SQL = "SELECT COUNT(*) AS row_count FROM daily_metrics WHERE metric_date = '{date}'"
SUMMARY_SQL = "SELECT COUNT(*), SUM(daily_active_users) FROM daily_metrics"
PREVIEW_SQL = "SELECT * FROM daily_metrics WHERE metric_date = '{date}' LIMIT 5"
ROUNDED_SQL = ("SELECT metric_date, daily_active_users, "
               "ROUND(CAST(total_revenue AS DECIMAL(38,6)), 2) AS revenue, top_product_id "
               "FROM daily_metrics WHERE metric_date = '{date}'")


def register_view(spark: SparkSession, mart: DataFrame, name: str = VIEW_NAME) -> str:
    """Expose the mart view to SQL under ``name`` (a session temp view)."""
    mart.select(*MART_COLUMNS).createOrReplaceTempView(name)
    return name
