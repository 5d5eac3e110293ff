"""Data quality checks as one-pass aggregates (Q2–Q8).

Each check returns a small report DataFrame; the gates in ``plans.pipeline``
raise on failure. No check collects rows: every count is a Spark aggregate with
map-side partial aggregation, and the reports hold one row per check or date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daybook.functions.exact import summable
from daybook.operators import generate
from daybook.operators.silver import rejected
from daybook.schema import BRONZE_COLUMNS, BRONZE_TEXT_DDL, RAW_RECORD

# The ranges the event source draws from (its fixed values, see operators.generate).
USER_ID_RANGE = (1, generate.USERS)
PRODUCT_ID_RANGE = (1, generate.PRODUCTS)
PURCHASE_AMOUNT_RANGE = tuple(c / 100 for c in generate.AMOUNT_CENTS)
EVENT_TYPES = [name for name, _ in generate.TYPE_SHARES]


def _unpivot(agg: DataFrame, names: list[str], name_col: str, value_col: str) -> DataFrame:
    return agg.unpivot([], names, name_col, value_col)


def null_counts(bronze: DataFrame, columns=None) -> DataFrame:
    """(column_name, null_count): ``count(*) - count(col)`` for every column, one pass."""
    columns = columns or BRONZE_COLUMNS
    agg = bronze.agg(*[(F.count(F.lit(1)) - F.count(c)).alias(c) for c in columns])
    return _unpivot(agg, columns, "column_name", "null_count")


def _numeric_checks() -> dict[str, Column]:
    amount, etype = F.col("amount"), F.col("event_type")
    lo, hi = PURCHASE_AMOUNT_RANGE
    return {
        "user_id_in_range": F.col("user_id").isNotNull()
        & ~F.col("user_id").between(*USER_ID_RANGE),
        "product_id_in_range": F.col("product_id").isNotNull()
        & ~F.col("product_id").between(*PRODUCT_ID_RANGE),
        # NaN or ±Infinity: the exact revenue sum leaves it out.
        "amount_summable": amount.isNotNull() & ~summable("amount"),
        "amount_not_negative": amount < 0,
        "purchase_amount_in_range": (etype == "purchase") & amount.isNotNull()
        & ~amount.between(lo, hi),
        "non_purchase_amount_zero": etype.isNotNull() & (etype != "purchase")
        & amount.isNotNull() & (amount != 0),
        "event_type_known": etype.isNotNull() & ~etype.isin(EVENT_TYPES),
    }


def numeric_validity(bronze: DataFrame) -> DataFrame:
    """(check, failures, passed) over typed Bronze rows, one pass."""
    checks = _numeric_checks()
    agg = bronze.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    return (_unpivot(agg, list(checks), "check", "failures")
            .withColumn("passed", F.col("failures") == 0))


def _cast_failure_columns() -> dict[str, Column]:
    """Per checked column: the text was present in the file but the typed value is NULL.

    Works on :func:`daybook.sources.bronze.read_bronze_checked`: the CSV reader's
    own conversion failures are the rows with a raw line, whose fields are split
    again with ``from_csv`` (only those rows). The timestamp stays text in Bronze,
    so its check parses it the way cleaning does.
    """
    raw = F.from_csv(F.col(RAW_RECORD), BRONZE_TEXT_DDL)

    def failed(name: str) -> Column:
        return raw.getField(name).isNotNull() & F.col(name).isNull()

    return {
        "user_id": failed("user_id"),
        "product_id": failed("product_id"),
        "amount": failed("amount"),
        "event_timestamp": F.col("event_timestamp").isNotNull()
        & F.try_to_timestamp("event_timestamp").isNull(),
    }


def cast_failures(bronze_checked: DataFrame) -> DataFrame:
    """(column_name, failures): values present in the file that did not type-check.

    ``bronze_checked`` is Bronze read by ``read_bronze_checked``, so a value the
    typed read silently turned into NULL is counted here, exactly as the CSV
    reader judged it.
    """
    checks = _cast_failure_columns()
    agg = bronze_checked.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    return _unpivot(agg, list(checks), "column_name", "failures")


def counts_by_date(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("process_date").agg(F.count(F.lit(1)).alias(name))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, process_date, row_count) for each named layer."""
    out = None
    for layer, df in layers.items():
        part = df.groupBy("process_date").agg(F.count(F.lit(1)).alias("row_count")) \
                 .select(F.lit(layer).alias("layer"), "process_date", "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def reconcile(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Per arrival date: Bronze = Silver + rejected, and at least one Gold row.

    Inputs are aggregated to one row per date before the join, so the join is
    between per-date counts (rows = dates).
    """
    # Bronze rows and rejected rows in one pass over Bronze.
    b = bronze.groupBy("process_date").agg(F.count(F.lit(1)).alias("bronze_rows"),
                                           F.count_if(rejected(bronze)).alias("rejected_rows"))
    s = counts_by_date(silver, "silver_rows")
    g = counts_by_date(gold, "gold_rows")
    zero = F.lit(0).cast("bigint")
    out = (b.join(s, "process_date", "full").join(g, "process_date", "full")
            .select("process_date",
                    *[F.coalesce(c, zero).alias(c) for c in
                      ["bronze_rows", "silver_rows", "rejected_rows", "gold_rows"]]))
    return out.withColumn(
        "passed",
        (F.col("bronze_rows") == F.col("silver_rows") + F.col("rejected_rows"))
        & (F.col("gold_rows") >= 1))


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """(process_date, duplicate_rows): rows whose event_id occurs more than once.

    Duplicates are kept by the pipeline (there is no dedup); this only reports them.
    The report runs it on Silver, the rows that reach the metrics: one Parquet
    column instead of a second parse of the CSV. One shuffle on
    (process_date, event_id) with partial counts.
    """
    per_id = rows.where(F.col("event_id").isNotNull()) \
        .groupBy("process_date", "event_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("process_date").agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint")
        .alias("duplicate_rows"))


def date_spill(silver: DataFrame) -> DataFrame:
    """(process_date, spilled_rows): cleaned rows whose event date is not the arrival date."""
    return silver.groupBy("process_date").agg(
        F.count_if(F.col("event_date") != F.col("process_date")).alias("spilled_rows"))


def layer_digest(rows: DataFrame, columns=None) -> DataFrame:
    """(process_date, row_count, digest): a date's rows as a count and a sum of row hashes.

    Independent of order and files, so two runs of a date can be compared without
    bringing their rows together. Partial sums per task, one row per date after.
    """
    columns = columns or [c for c in rows.columns if c != "process_date"]
    return rows.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("digest"))


# Metrics of so many dates go into one observation; more dates take several.
OBSERVED_DATES = 64


class WriteDigest:
    """Row count and digest of each date, observed while the rows are written.

    The metrics are conditional aggregates in the write's own job (``DataFrame.observe``):
    the hash is computed once a row, for its own date. Nothing is read again.
    """

    def __init__(self, dates, columns):
        dates = list(dates)
        self.columns = list(columns)
        self.groups = [(dates[i:i + OBSERVED_DATES], Observation())
                       for i in range(0, len(dates), OBSERVED_DATES)]

    def observe(self, df: DataFrame) -> DataFrame:
        for dates, seen in self.groups:
            hashed = f"CAST(xxhash64({', '.join(self.columns)}) AS DECIMAL(38,0))"
            metrics = [F.expr(e) for i, d in enumerate(dates) for own in [f"process_date = DATE'{d}'"]
                       for e in (f"count_if({own}) AS n{i}",
                                 f"sum(CASE WHEN {own} THEN {hashed} END) AS h{i}")]
            df = df.observe(seen, *metrics)
        return df

    def by_date(self) -> dict[str, dict]:
        """After the write: date -> row_count and digest, for dates that have rows."""
        found = {}
        for dates, seen in self.groups:
            got = seen.get
            found |= {d: {"row_count": got[f"n{i}"], "digest": str(got[f"h{i}"])}
                      for i, d in enumerate(dates) if got[f"n{i}"]}
        return found


def changed_dates(before: DataFrame, after: DataFrame) -> DataFrame:
    """(process_date, row_count, unchanged) of two :func:`layer_digest` results."""
    old = before.select("process_date", F.struct("row_count", "digest").alias("old"))
    new = after.select("process_date", F.struct("row_count", "digest").alias("new"))
    return old.join(new, "process_date", "full").select(
        "process_date", F.coalesce("new.row_count", F.lit(0).cast("bigint")).alias("row_count"),
        F.col("old").eqNullSafe(F.col("new")).alias("unchanged"))


# The checks of the daily report and what each must equal. The three
# row counts of the layers must be at least their expected value, all others equal it.
AT_LEAST = {"bronze_rows": 1, "silver_rows": 1, "gold_rows": 1}
EXACT = {"mart_rows": 1, "rows_reconciled": 0, "rejected_rows": 0, "silver_null_keys": 0,
         "cast_failures": 0, "duplicate_event_ids": 0, "date_spill_rows": 0}
NUMERIC_CHECKS = ["user_id_in_range", "product_id_in_range", "amount_summable",
                  "amount_not_negative", "purchase_amount_in_range", "non_purchase_amount_zero",
                  "event_type_known"]
REPORT_CHECKS = [*AT_LEAST, *EXACT, *NUMERIC_CHECKS]


def _any_null(cols) -> Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return cond


def report(bronze_checked: DataFrame, silver: DataFrame, gold: DataFrame,
           mart_view: DataFrame, dates=None) -> DataFrame:
    """All checks as one report: (process_date, check, observed, expected, passed).

    Every source is aggregated to one row per arrival date in a single pass: one
    Bronze scan (``read_bronze_checked``) yields the row count, rejected rows,
    cast failures and numeric checks. The per-date rows are joined and
    unpivoted. Duplicate ids are counted on Silver (one Parquet column) with their
    own shuffle on (date, event_id) and partial counts. Without ``dates`` every date
    that any layer holds gets its rows; with ``dates`` every requested one, so a date
    without Bronze shows zero counts.
    """
    bronze = bronze_checked
    numeric = _numeric_checks()
    assert list(numeric) == NUMERIC_CHECKS
    zero = F.lit(0).cast("bigint")
    any_cast = None
    for cond in _cast_failure_columns().values():
        any_cast = cond if any_cast is None else (any_cast | cond)
    b = bronze.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(rejected(bronze)).alias("rejected_rows"),
        F.count_if(any_cast).alias("cast_failures"),
        *[F.count_if(c).alias(n) for n, c in numeric.items()])
    s = silver.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(_any_null(["event_id", "user_id", "product_id", "event_timestamp"]))
        .alias("silver_null_keys"),
        F.count_if(F.col("event_date") != F.col("process_date")).alias("date_spill_rows"))
    g = gold.groupBy("process_date").agg(F.count(F.lit(1)).alias("gold_rows"))
    d = duplicate_ids(silver).withColumnRenamed("duplicate_rows", "duplicate_event_ids")
    m = mart_view.groupBy(F.col("metric_date").alias("process_date")) \
        .agg(F.count(F.lit(1)).alias("mart_rows"))
    wide = b
    for part in (s, g, d, m):
        wide = wide.join(part, "process_date", "full")
    if dates is not None:
        asked = bronze.sparkSession.createDataFrame(
            [(dt.date.fromisoformat(x),) for x in dates], "process_date date")
        wide = asked.join(wide, "process_date", "left")
    wide = wide.select(
        "process_date",
        *[F.coalesce(F.col(c), zero).alias(c) for c in
          ["bronze_rows", "silver_rows", "gold_rows", "mart_rows", "rejected_rows",
           "silver_null_keys", "cast_failures", "duplicate_event_ids", "date_spill_rows",
           *numeric]],
    ).withColumn("rows_reconciled",
                 F.col("bronze_rows") - F.col("silver_rows") - F.col("rejected_rows"))
    long = wide.unpivot(["process_date"], REPORT_CHECKS, "check", "observed")
    expected = F.lit(0).cast("bigint")
    for name, value in {**AT_LEAST, **EXACT}.items():
        expected = F.when(F.col("check") == name, F.lit(value).cast("bigint")).otherwise(expected)
    at_least = F.col("check").isin(list(AT_LEAST))
    return long.withColumn("expected", expected).withColumn(
        "passed", F.when(at_least, F.col("observed") >= F.col("expected"))
        .otherwise(F.col("observed") == F.col("expected")))
