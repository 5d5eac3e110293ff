"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from daybook import oracle
from daybook.plans import catalog
from tools.check_oracle import compare

KEYS = sorted(catalog.queries())


def test_every_query_has_oracle_sql():
    assert set(oracle.oracle_sql()) == set(KEYS)
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    res = compare(spark, SF_SMALL, [key], verbose=True)
    ok, rows, _ = res[key]
    assert ok is True, f"{key} differs from its oracle"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len({r.process_date for r in rows}) == 30 < len(rows)  # late events have rows too
    assert df.columns == ["process_date", "event_date", "daily_active_users", "total_revenue",
                          "top_product_id", "top_product_revenue"]


def test_entry_module_imports_without_a_session():
    import subprocess
    import sys
    from conftest import ROOT
    code = ("import __spark_entry__ as E; q = E.queries(); o = E.oracle_sql(); "
            "assert set(o) <= set(q); print(len(o) > 30)")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                         timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "True"


@pytest.mark.parametrize("key", ["backfill_gold", "gold_by_date", "mart_replace", "dq_report"])
def test_file_backed_queries_repeat(spark, key):
    """Calling a query again (new scratch folders, shared warehouse) gives the same rows."""
    from collections import Counter
    q = E.queries()[key]
    first = Counter(repr(tuple(r)) for r in q(spark, SF_SMALL).collect())
    second = Counter(repr(tuple(r)) for r in q(spark, SF_SMALL).collect())
    assert first == second and sum(first.values()) > 0
