"""Silver → Gold: one metrics row per event date.

Keys default to ``["event_date"]``; the pipeline passes
``["process_date", "event_date"]`` so that rows of different arrival dates stay
apart (an event that arrives a day late is filed under its arrival date).

Revenue is an exact sum of doubles (``functions.exact``): parts by exponent bin are added as
decimals, and only a finished sum is rounded.

Shuffles at scale:
* revenue parts: partial sums per map task, then one shuffle on (keys, product_id, bin); a hot
  date or product is pre-aggregated map-side. Everyday amounts have one bin. Finished sums, the
  total and the top product come from these rows, never from raw ones.
* distinct users: Spark's distinct plan shuffles on (keys, user_id) first and on
  keys only after that, so no single task receives all rows of a hot date. The pipeline
  takes them from mergeable bitmaps instead (``operators.parts``).
* the final joins are between per-date results (rows = dates); AQE turns them
  into broadcasts from runtime statistics, not from a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.exact import exact_part, part_list, part_sum, with_double, with_rest

DEFAULT_KEYS = ["event_date"]


def _keys(keys):
    return list(keys) if keys else list(DEFAULT_KEYS)


def revenue_parts(silver: DataFrame, keys=None) -> DataFrame:
    """(keys, product_id, bin, part): exact sums of the amounts by exponent bin.

    A product without a summable amount has one row whose bin and part are NULL.
    """
    amount = exact_part("amount")
    return (silver.select(*_keys(keys), "product_id", amount.alias("_amount"))
            .groupBy(*_keys(keys), "product_id", F.col("_amount.bin").alias("bin"))
            .agg(part_sum("_amount.part").alias("part")))


def merge_parts(parts: DataFrame, keys=None) -> DataFrame:
    """The same for fewer keys, or for parts that stand in several rows."""
    return parts.groupBy(*_keys(keys), "product_id", "bin").agg(part_sum().alias("part"))


def product_sums(parts: DataFrame, keys=None) -> DataFrame:
    """(keys, product_id, revenue, rest) of merged parts.

    ``revenue`` is the nearest double and ``rest`` what it leaves of the exact sum.
    """
    lists = parts.groupBy(*_keys(keys), "product_id").agg(part_list().alias("_parts"))
    return with_rest(with_double(lists, "_parts", "revenue"), "_parts", "revenue", "rest").drop("_parts")


def product_revenue_exact(silver: DataFrame, keys=None) -> DataFrame:
    """The same from Silver rows."""
    return product_sums(revenue_parts(silver, keys), keys)


def total_revenue(parts: DataFrame, keys=None) -> DataFrame:
    """(keys, total_revenue): all products' parts added and rounded once."""
    by_bin = parts.groupBy(*_keys(keys), "bin").agg(part_sum().alias("part"))
    lists = by_bin.groupBy(*_keys(keys)).agg(part_list().alias("_parts"))
    return with_double(lists, "_parts", "total_revenue").drop("_parts")


def daily_totals(silver: DataFrame, keys=None) -> DataFrame:
    """Exact distinct users and summed revenue per date."""
    keys = _keys(keys)
    users = silver.groupBy(*keys).agg(F.count_distinct("user_id").alias("daily_active_users"))
    return users.join(total_revenue(revenue_parts(silver, keys), keys), keys, "left")


def product_revenue(silver: DataFrame, keys=None) -> DataFrame:
    """Summed revenue per (date, product) as a double ``product_revenue``."""
    return product_revenue_exact(silver, keys).select(
        *_keys(keys), "product_id", F.col("revenue").alias("product_revenue"))


def _top_order():
    # Largest revenue first, NULL revenue last, ties to the smaller product id.
    return [F.col("revenue").desc_nulls_last(), F.col("rest").desc_nulls_last(),
            F.col("product_id").asc()]


def top_product(per_product: DataFrame, keys=None) -> DataFrame:
    """Top-1 product per date by ``row_number`` (planned as WindowGroupLimit)."""
    keys = _keys(keys)
    w = Window.partitionBy(*keys).orderBy(*_top_order())
    return (per_product.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") == 1)
            .select(*keys,
                    F.col("product_id").alias("top_product_id"),
                    F.col("revenue").alias("top_product_revenue")))


def _best_struct():
    # Orders like _top_order: a NULL revenue sorts below any value, and for equal
    # revenue the larger negated id (= smaller id) wins. The least int has no int
    # negative, so ids are negated as bigint and cast back.
    return F.struct(F.col("revenue").isNotNull().alias("has"),
                    F.coalesce(F.col("revenue"), F.lit(0.0)).alias("rev"),
                    F.coalesce(F.col("rest"), F.lit(0.0)).alias("rest"),
                    (-F.col("product_id").cast("bigint")).alias("neg_id"))


def top_product_max_by(per_product: DataFrame, keys=None) -> DataFrame:
    """Top-1 product per date as one aggregate (same answer as :func:`top_product`)."""
    keys = _keys(keys)
    best = F.max(_best_struct())
    return (per_product.groupBy(*keys).agg(best.alias("best"))
            .select(*keys,
                    (-F.col("best.neg_id")).cast("int").alias("top_product_id"),
                    F.when(F.col("best.has"), F.col("best.rev")).alias("top_product_revenue")))


def gold_from_parts(parts: DataFrame, users: DataFrame, keys=None) -> DataFrame:
    """The Gold table of merged revenue parts and (keys, daily_active_users)."""
    keys = _keys(keys)
    best = top_product_max_by(product_sums(parts, keys), keys)
    return (users.join(total_revenue(parts, keys), keys, "left").join(best, keys, "left")
            .select(*keys, "daily_active_users", "total_revenue", "top_product_id",
                    "top_product_revenue"))


def aggregate_to_gold(silver: DataFrame, keys=None) -> DataFrame:
    """The Gold table: distinct users, revenue and the top product per date, from Silver rows."""
    keys = _keys(keys)
    users = silver.groupBy(*keys).agg(F.count_distinct("user_id").alias("daily_active_users"))
    return gold_from_parts(revenue_parts(silver, keys), users, keys)
