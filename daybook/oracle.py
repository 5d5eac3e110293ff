"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written independently of the Spark code: the same fixture mapping and
the same semantics, stated as plain SQL over the given tables.
"""

from __future__ import annotations

# The fixture defect rule (see daybook.plans.fixture) and the fixed
# process date used by the single-date keys.
FIXED_DATE = "2024-01-12"

BASE = """
WITH raw AS (
  SELECT CASE WHEN event_id % 17 = 0 THEN 'again-' || CAST(CAST(ts AS DATE) AS VARCHAR)
              ELSE CAST(event_id AS VARCHAR) END AS event_id,
         CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 59 = 0 THEN 'user-x'
              ELSE CAST(user_id AS VARCHAR) END AS user_text,
         event_type,
         CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 61 = 0 THEN 'none'
              ELSE json_extract_string(props, '$.k') END AS product_text,
         CASE WHEN event_id % 41 = 0 THEN 'garbage'
              WHEN event_id % 43 = 0 THEN CAST(ts - INTERVAL 1 DAY AS VARCHAR)
              ELSE CAST(ts AS VARCHAR) END AS event_timestamp,
         CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 67 = 0 THEN '12.3.4'
              WHEN event_id % 79 = 0 THEN 'NaN' WHEN event_id % 997 = 0 THEN '1e25'
              WHEN event_id % 73 = 0 THEN '1e-9'
              WHEN event_id % 83 = 0 THEN '-5.25' WHEN event_id % 23 = 0 THEN '9999.125'
              WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) ELSE '0.0' END AS amount_text,
         CAST(ts AS DATE) AS process_date
  FROM events),
bronze AS (
  SELECT *, TRY_CAST(user_text AS INT) AS user_id, TRY_CAST(product_text AS INT) AS product_id,
         TRY_CAST(amount_text AS DOUBLE) AS amount,
         TRY_CAST(amount_text AS DECIMAL(38,9)) AS money
  FROM raw),
parsed AS (SELECT *, TRY_CAST(event_timestamp AS TIMESTAMP) AS ts_parsed FROM bronze),
silver AS (
  SELECT event_id, user_id, event_type, product_id, amount, money,
         ts_parsed AS event_timestamp, CAST(ts_parsed AS DATE) AS event_date,
         strftime(ts_parsed, '%a') AS day_of_week, process_date
  FROM parsed
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
    AND ts_parsed IS NOT NULL),
a AS (
  SELECT process_date, event_date, COUNT(DISTINCT user_id) AS daily_active_users,
         SUM(money) AS rev
  FROM silver GROUP BY process_date, event_date),
p AS (
  SELECT process_date, event_date, product_id, SUM(money) AS r
  FROM silver GROUP BY process_date, event_date, product_id),
k AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY process_date, event_date
                               ORDER BY r DESC NULLS LAST, product_id) AS rn
  FROM p),
gold AS (
  SELECT a.process_date, a.event_date, a.daily_active_users,
         CAST(a.rev AS DOUBLE) AS total_revenue,
         k.product_id AS top_product_id, CAST(k.r AS DOUBLE) AS top_product_revenue
  FROM a LEFT JOIN (SELECT * FROM k WHERE rn = 1) k
    ON a.process_date = k.process_date AND a.event_date = k.event_date),
mart AS (
  SELECT event_date AS metric_date, CAST(daily_active_users AS INT) AS daily_active_users,
         total_revenue, top_product_id, top_product_revenue, process_date
  FROM gold)
"""

_Q: dict[str, str] = {}


def _reg(name: str, body: str) -> None:
    """Register ``body`` after the shared CTEs; a body starting with ',' adds CTEs."""
    body = body.strip()
    _Q[name] = BASE.rstrip() + ("\n" if body.startswith(",") else "\n") + body + "\n"


D = f"DATE '{FIXED_DATE}'"
MONEY_SUM = "SUM(money)"
SILVER_OUT = """SELECT event_id, user_id, event_type, product_id, amount,
       CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, event_date, day_of_week
FROM silver"""
GOLD_OUT = """SELECT process_date, event_date, daily_active_users, total_revenue, top_product_id,
       top_product_revenue
FROM gold"""
MART_OUT = """SELECT metric_date, daily_active_users, total_revenue, top_product_id,
       top_product_revenue
FROM mart"""
# Of several rows of a date the one with most users comes first.
WITHIN_DATE = "daily_active_users DESC, total_revenue DESC NULLS LAST, top_product_id NULLS LAST"
TOP_BY_EVENT_DATE = f"""
, pp AS (SELECT event_date, product_id, {MONEY_SUM} AS r FROM silver
         GROUP BY event_date, product_id),
kk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_date
                                    ORDER BY r DESC NULLS LAST, product_id) AS rn FROM pp)
SELECT event_date, product_id AS top_product_id, CAST(r AS DOUBLE) AS top_product_revenue
FROM kk WHERE rn = 1
"""

_reg("bronze_scan", """
SELECT event_id, user_id, event_type, product_id, event_timestamp, amount FROM bronze
""")
_reg("silver_clean", SILVER_OUT)
_reg("silver_by_date", SILVER_OUT + f" WHERE process_date = {D}")
_reg("gold_by_date", GOLD_OUT + f" WHERE process_date = {D}")
_reg("partition_columns", """
SELECT process_date, strftime(process_date, '%Y') AS year, strftime(process_date, '%m') AS month,
       strftime(process_date, '%d') AS day, COUNT(*) AS n
FROM silver GROUP BY process_date
""")
_reg("daily_totals", f"""
SELECT event_date, COUNT(DISTINCT user_id) AS daily_active_users,
       CAST({MONEY_SUM} AS DOUBLE) AS total_revenue
FROM silver GROUP BY event_date
""")
_reg("product_revenue", f"""
SELECT event_date, product_id, CAST({MONEY_SUM} AS DOUBLE) AS product_revenue
FROM silver GROUP BY event_date, product_id
""")
_reg("top_product", TOP_BY_EVENT_DATE)
_reg("top_product_max_by", TOP_BY_EVENT_DATE)
_reg("gold_daily_metrics", GOLD_OUT)
_reg("backfill_gold", GOLD_OUT)
_reg("mart_rows", MART_OUT)
_reg("mart_replace", MART_OUT)
_reg("dashboard_table", MART_OUT + f" ORDER BY metric_date, {WITHIN_DATE}")
_reg("mart_by_date", MART_OUT + f" WHERE metric_date = {D}")
_reg("mart_count_by_date", f"SELECT COUNT(*) AS row_count FROM mart WHERE metric_date = {D}")
_reg("mart_summary", """
SELECT COUNT(*) AS row_count, CAST(SUM(daily_active_users) AS BIGINT) AS dau_sum FROM mart
""")
_reg("mart_revenue_rounded", f"""
SELECT metric_date, daily_active_users,
       CAST(ROUND(CAST(total_revenue AS DECIMAL(38,6)), 2) AS DOUBLE) AS revenue, top_product_id
FROM mart WHERE metric_date = {D}
""")
_reg("mart_preview", MART_OUT + f" ORDER BY metric_date, {WITHIN_DATE} LIMIT 3")
_reg("kpi_latest", f"""
SELECT metric_date, daily_active_users, total_revenue,
       COALESCE(top_product_revenue, CAST(0.0 AS DOUBLE)) AS top_product_revenue
FROM mart ORDER BY metric_date DESC, {WITHIN_DATE} LIMIT 1
""")
_reg("dau_series", "SELECT metric_date, daily_active_users FROM mart ORDER BY metric_date")
_reg("revenue_series", "SELECT metric_date, total_revenue FROM mart ORDER BY metric_date")
_reg("layer_counts", """
SELECT 'bronze' AS layer, process_date, COUNT(*) AS row_count FROM bronze GROUP BY process_date
UNION ALL
SELECT 'silver' AS layer, process_date, COUNT(*) AS row_count FROM silver GROUP BY process_date
UNION ALL
SELECT 'gold' AS layer, process_date, COUNT(*) AS row_count FROM gold GROUP BY process_date
UNION ALL
SELECT 'mart' AS layer, metric_date AS process_date, COUNT(*) AS row_count FROM mart
GROUP BY metric_date
""")
_reg("dq_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM bronze"
    for c in ["event_id", "user_id", "event_type", "product_id", "event_timestamp", "amount"]))
_reg("dq_reconcile", """
, b AS (SELECT process_date, COUNT(*) AS n FROM bronze GROUP BY process_date),
s AS (SELECT process_date, COUNT(*) AS n FROM silver GROUP BY process_date),
r AS (SELECT process_date, COUNT(*) AS n FROM parsed
      WHERE event_id IS NULL OR user_id IS NULL OR product_id IS NULL OR ts_parsed IS NULL
      GROUP BY process_date),
g AS (SELECT process_date, COUNT(*) AS n FROM gold GROUP BY process_date),
j AS (SELECT b.process_date, b.n AS bronze_rows, COALESCE(s.n, 0) AS silver_rows,
             COALESCE(r.n, 0) AS rejected_rows, COALESCE(g.n, 0) AS gold_rows
      FROM b LEFT JOIN s ON b.process_date = s.process_date
             LEFT JOIN r ON b.process_date = r.process_date
             LEFT JOIN g ON b.process_date = g.process_date)
SELECT process_date, CAST(bronze_rows AS BIGINT) AS bronze_rows,
       CAST(silver_rows AS BIGINT) AS silver_rows, CAST(rejected_rows AS BIGINT) AS rejected_rows,
       CAST(gold_rows AS BIGINT) AS gold_rows,
       bronze_rows = silver_rows + rejected_rows AND gold_rows >= 1 AS passed
FROM j
""")
_NUMERIC = {
    "user_id_in_range": "user_id IS NOT NULL AND NOT (user_id BETWEEN 1 AND 100000)",
    "product_id_in_range": "product_id IS NOT NULL AND NOT (product_id BETWEEN 1 AND 5000)",
    "amount_summable": "amount IS NOT NULL AND money IS NULL",
    "amount_not_negative": "amount < 0",
    "purchase_amount_in_range": "event_type = 'purchase' AND amount IS NOT NULL "
                                "AND NOT (amount BETWEEN 5.0 AND 500.0)",
    "non_purchase_amount_zero": "event_type IS NOT NULL AND event_type <> 'purchase' "
                                "AND amount IS NOT NULL AND amount <> 0",
    "event_type_known": "event_type IS NOT NULL "
                        "AND event_type NOT IN ('view', 'click', 'purchase')",
}
_reg("dq_numeric", " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", COUNT(*) FILTER (WHERE {cond}) AS failures, "
    f"COUNT(*) FILTER (WHERE {cond}) = 0 AS passed FROM bronze"
    for name, cond in _NUMERIC.items()))
# Text as it stands in the file, and its typed value.
_CASTS = {
    "user_id": ("user_text", "user_id"),
    "product_id": ("product_text", "product_id"),
    "amount": ("amount_text", "amount"),
    "event_timestamp": ("event_timestamp", "TRY_CAST(event_timestamp AS TIMESTAMP)"),
}
_reg("dq_cast_failures", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {text} IS NOT NULL AND {typed} IS NULL) "
    f"AS failures FROM bronze" for c, (text, typed) in _CASTS.items()))
_reg("dq_duplicate_ids", """
, per_id AS (SELECT process_date, event_id, COUNT(*) AS n FROM silver
             WHERE event_id IS NOT NULL GROUP BY process_date, event_id)
SELECT process_date, CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows
FROM per_id GROUP BY process_date
""")
_reg("dq_date_spill", """
SELECT process_date, COUNT(*) FILTER (WHERE event_date <> process_date) AS spilled_rows
FROM silver GROUP BY process_date
""")

_ANY_NULL_KEY = "event_id IS NULL OR user_id IS NULL OR product_id IS NULL"
_AT_LEAST = {"bronze_rows": 1, "silver_rows": 1, "gold_rows": 1}
_EXACT = {"mart_rows": 1, "rows_reconciled": 0, "rejected_rows": 0, "silver_null_keys": 0,
          "cast_failures": 0, "duplicate_event_ids": 0, "date_spill_rows": 0}
_numeric_cols = ",\n       ".join(f"COUNT(*) FILTER (WHERE {c}) AS {n}"
                                  for n, c in _NUMERIC.items())
_any_cast = " OR ".join(f"({c} IS NOT NULL AND {t} IS NULL)" for c, t in _CASTS.values())
_report_checks = [*_AT_LEAST, *_EXACT, *_NUMERIC]
_union = "\nUNION ALL\n".join(
    f"SELECT process_date, '{c}' AS \"check\", {c} AS observed, "
    f"CAST({_AT_LEAST.get(c, _EXACT.get(c, 0))} AS BIGINT) AS expected, "
    f"{c} {'>=' if c in _AT_LEAST else '='} {_AT_LEAST.get(c, _EXACT.get(c, 0))} AS passed FROM w"
    for c in _report_checks)
_reg("dq_report", f"""
, rb AS (
  SELECT process_date, COUNT(*) AS bronze_rows,
         COUNT(*) FILTER (WHERE {_ANY_NULL_KEY} OR TRY_CAST(event_timestamp AS TIMESTAMP) IS NULL)
           AS rejected_rows,
         COUNT(*) FILTER (WHERE {_any_cast}) AS cast_failures,
         {_numeric_cols}
  FROM bronze GROUP BY process_date),
ds AS (
  SELECT process_date, event_id, product_id, event_timestamp, event_date,
         CASE WHEN process_date = DATE '2024-01-21' AND product_id % 2 = 0 THEN NULL
              ELSE user_id END AS user_id
  FROM silver WHERE process_date <> DATE '2024-01-20'),
rs AS (
  SELECT process_date, COUNT(*) AS silver_rows,
         COUNT(*) FILTER (WHERE {_ANY_NULL_KEY} OR event_timestamp IS NULL) AS silver_null_keys,
         COUNT(*) FILTER (WHERE event_date <> process_date) AS date_spill_rows
  FROM ds GROUP BY process_date),
rg AS (SELECT process_date, COUNT(*) AS gold_rows FROM gold GROUP BY process_date),
per_id AS (SELECT process_date, event_id, COUNT(*) AS n FROM ds
           WHERE event_id IS NOT NULL GROUP BY process_date, event_id),
rd AS (SELECT process_date, COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS dup
       FROM per_id GROUP BY process_date),
rm AS (SELECT metric_date AS process_date, COUNT(*) AS mart_rows FROM mart GROUP BY metric_date),
days AS (SELECT process_date FROM rb UNION SELECT process_date FROM rs
         UNION SELECT process_date FROM rg UNION SELECT process_date FROM rm),
w AS (
  SELECT days.process_date,
         CAST(COALESCE(bronze_rows, 0) AS BIGINT) AS bronze_rows,
         CAST(COALESCE(silver_rows, 0) AS BIGINT) AS silver_rows,
         CAST(COALESCE(gold_rows, 0) AS BIGINT) AS gold_rows,
         CAST(COALESCE(mart_rows, 0) AS BIGINT) AS mart_rows,
         CAST(COALESCE(rejected_rows, 0) AS BIGINT) AS rejected_rows,
         CAST(COALESCE(bronze_rows, 0) - COALESCE(silver_rows, 0) - COALESCE(rejected_rows, 0)
              AS BIGINT) AS rows_reconciled,
         CAST(COALESCE(silver_null_keys, 0) AS BIGINT) AS silver_null_keys,
         CAST(COALESCE(cast_failures, 0) AS BIGINT) AS cast_failures,
         CAST(COALESCE(dup, 0) AS BIGINT) AS duplicate_event_ids,
         CAST(COALESCE(date_spill_rows, 0) AS BIGINT) AS date_spill_rows,
         {", ".join(f"CAST(COALESCE({n}, 0) AS BIGINT) AS {n}" for n in _NUMERIC)}
  FROM days LEFT JOIN rb ON days.process_date = rb.process_date
            LEFT JOIN rs ON days.process_date = rs.process_date
            LEFT JOIN rg ON days.process_date = rg.process_date
            LEFT JOIN rd ON days.process_date = rd.process_date
            LEFT JOIN rm ON days.process_date = rm.process_date)
{_union}
""")


# --- Gates, listings and reruns ---------------------------------------------------------

_reg("bronze_listing", """
SELECT process_date, COUNT(*) AS row_count FROM bronze GROUP BY process_date
""")
_reg("bronze_present", """
, span AS (SELECT MIN(process_date) - 1 AS a, MAX(process_date) + 1 AS b FROM bronze)
SELECT CAST(d.day AS DATE) AS process_date,
       EXISTS (SELECT 1 FROM bronze WHERE process_date = CAST(d.day AS DATE)) AS present
FROM span, generate_series(span.a, span.b, INTERVAL 1 DAY) AS d(day)
""")
_reg("mart_catalog", MART_OUT.replace("SELECT ", "SELECT process_date, ", 1))
_reg("mart_load_time", """
SELECT process_date, metric_date, TRUE AS loaded_in_run FROM mart
""")
_reg("empty_mart", """
SELECT 'cleared' AS state, CAST(0 AS BIGINT) AS row_count, TRUE AS message_shown
UNION ALL SELECT 'loaded', COUNT(*), COUNT(*) = 0 FROM mart
""")
_reg("idempotency", """
SELECT 'silver' AS layer, process_date, COUNT(*) AS row_count, TRUE AS unchanged FROM silver
GROUP BY process_date
UNION ALL SELECT 'gold', process_date, COUNT(*), TRUE FROM gold GROUP BY process_date
UNION ALL SELECT 'mart', process_date, COUNT(*), TRUE FROM mart GROUP BY process_date
""")
_reg("gate_order", f"""
SELECT {D} AS process_date, '1 silver' AS step, COUNT(*) AS row_count FROM silver
WHERE process_date = {D}
UNION ALL SELECT {D}, '2 gold', COUNT(*) FROM gold WHERE process_date = {D}
UNION ALL SELECT {D}, '3 mart', COUNT(*) FROM mart
          WHERE metric_date = {D} AND process_date = {D}
UNION ALL SELECT MAX(process_date) + 1, '0 stopped', CAST(0 AS BIGINT) FROM bronze
""")


_METRIC_DATES = """
, ma AS (SELECT event_date, COUNT(DISTINCT user_id) AS users, SUM(money) AS rev
         FROM silver GROUP BY event_date),
mp AS (SELECT event_date, product_id, SUM(money) AS r FROM silver GROUP BY event_date, product_id),
mk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_date
                                    ORDER BY r DESC NULLS LAST, product_id) AS rn FROM mp),
metric AS (SELECT ma.event_date AS metric_date, CAST(users AS INT) AS daily_active_users,
                  CAST(rev AS DOUBLE) AS total_revenue, product_id AS top_product_id,
                  CAST(r AS DOUBLE) AS top_product_revenue
           FROM ma JOIN mk ON ma.event_date = mk.event_date AND rn = 1)
"""
_reg("metric_dates", _METRIC_DATES + "SELECT * FROM metric")
_reg("metric_kpi", _METRIC_DATES + """
SELECT metric_date, daily_active_users, total_revenue,
       COALESCE(top_product_revenue, CAST(0.0 AS DOUBLE)) AS top_product_revenue
FROM metric ORDER BY metric_date DESC LIMIT 1
""")
_reg("metric_dau_series", _METRIC_DATES + """
SELECT metric_date, daily_active_users FROM metric ORDER BY metric_date
""")
_reg("metric_revenue_series", _METRIC_DATES + """
SELECT metric_date, total_revenue FROM metric ORDER BY metric_date
""")
_reg("late_files_gold", GOLD_OUT)
_reg("resumed_backfill", GOLD_OUT)
_reg("lost_commit", """
SELECT 'lost' AS state, process_date, metric_date, total_revenue FROM mart
UNION ALL SELECT 'done again', process_date, metric_date, CAST(-1 AS DOUBLE) FROM mart
""")


_reg("header_report", """
SELECT DISTINCT process_date,
       CASE day(process_date) % 7
         WHEN 0 THEN 'amount,event_timestamp,product_id,event_type,user_id,event_id'
         WHEN 3 THEN 'event_id,user_id,event_type,product_id,event_timestamp,amount,source'
         WHEN 5 THEN 'event_id,user_id,product_id,event_timestamp,amount'
         ELSE 'event_id,user_id,event_type,product_id,event_timestamp,amount' END AS header,
       CASE WHEN day(process_date) % 7 = 5 THEN 'event_type' ELSE '' END AS missing,
       CASE WHEN day(process_date) % 7 = 3 THEN 'source' ELSE '' END AS extra,
       day(process_date) % 7 = 0 AS reordered, day(process_date) % 7 NOT IN (0, 3, 5) AS passed
FROM bronze
""")
_reg("bronze_by_name", """
SELECT process_date, event_id, user_id,
       CASE WHEN day(process_date) % 7 <> 5 THEN event_type END AS event_type, product_id,
       event_timestamp, amount
FROM bronze
""")


def _draw(salt: str) -> str:
    return (f"CAST('0x' || substr(md5('{FIXED_DATE}:{salt}:' || CAST(event_id AS VARCHAR)), 1, 8)"
            f" AS BIGINT)")


_reg("gen_events", f"""
, g AS (
  SELECT md5('{FIXED_DATE}:event:' || CAST(event_id AS VARCHAR)) AS h,
         {_draw('user')} AS du, {_draw('type')} % 100 AS dt, {_draw('product')} AS dp,
         {_draw('time')} AS ds, {_draw('amount')} AS da
  FROM events)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
         || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS event_id,
       CAST(1 + du % 100000 AS INT) AS user_id,
       CASE WHEN dt < 70 THEN 'view' WHEN dt < 90 THEN 'click' ELSE 'purchase' END AS event_type,
       CAST(1 + dp % 5000 AS INT) AS product_id,
       strftime(TIMESTAMP '{FIXED_DATE} 00:00:00' + to_seconds(ds % 86400),
                '%Y-%m-%dT%H:%M:%S') AS event_timestamp,
       CASE WHEN dt >= 90 THEN CAST(500 + da % 49501 AS DOUBLE) / CAST(100 AS DOUBLE)
            ELSE CAST(0.0 AS DOUBLE) END AS amount
FROM g
""")


def oracle_sql() -> dict[str, str]:
    """Key → DuckDB SQL over the given tables."""
    return dict(_Q)
