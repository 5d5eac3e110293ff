"""End to end against an independent engine: DuckDB reads the Bronze CSV files
Spark wrote and computes Gold in SQL; the Spark pipeline must agree."""

import duckdb

from daybook.operators import generate
from daybook.schema import GOLD_COLUMNS
from daybook.plans import pipeline
from daybook.session import local_path
from daybook.sources import bronze

DATES = ["2026-03-01", "2026-03-02", "2026-03-03"]

GOLD_SQL = """
WITH b AS (
  SELECT *, CAST(regexp_extract(filename, 'date=([0-9-]+)', 1) AS DATE) AS process_date
  FROM read_csv('{root}/date=*/*.csv', header = true, filename = true,
                columns = {{'event_id': 'VARCHAR', 'user_id': 'INTEGER', 'event_type': 'VARCHAR',
                           'product_id': 'INTEGER', 'event_timestamp': 'VARCHAR',
                           'amount': 'DOUBLE'}})),
s AS (
  SELECT process_date, user_id, product_id, amount,
         CAST(TRY_CAST(event_timestamp AS TIMESTAMP) AS DATE) AS event_date
  FROM b
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
    AND TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL),
a AS (SELECT process_date, event_date, COUNT(DISTINCT user_id) AS dau,
             SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS rev
      FROM s GROUP BY ALL),
p AS (SELECT process_date, event_date, product_id, SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS r
      FROM s GROUP BY ALL),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY process_date, event_date
                                   ORDER BY r DESC NULLS LAST, product_id) AS rn FROM p)
SELECT a.process_date, a.event_date, a.dau, CAST(a.rev AS DOUBLE), k.product_id,
       CAST(k.r AS DOUBLE)
FROM a LEFT JOIN k ON a.process_date = k.process_date AND a.event_date = k.event_date
                  AND k.rn = 1
"""


def test_generated_pipeline_matches_duckdb_on_the_same_files(spark, root):
    paths = pipeline.Paths.under(root)
    for i, d in enumerate(DATES):
        bronze.write_bronze(generate.generate_events(spark, d, 40_000 + 10_000 * i), paths.bronze)
    pipeline.run_dates(spark, paths, DATES)
    ours = sorted(tuple(r) for r in pipeline.gold_for(spark, paths)
                  .select(*GOLD_COLUMNS).collect())
    theirs = sorted(duckdb.connect().execute(
        GOLD_SQL.format(root=local_path(paths.bronze))).fetchall())
    assert len(ours) == 3
    assert ours == theirs
