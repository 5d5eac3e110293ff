"""A materialised warehouse over the given tables, shared by the file-backed queries.

The ``events`` table is written as Bronze CSV by arrival date, then one backfill
job builds Silver and Gold for every date and loads the mart. The result lives
in a fresh folder below the shared checkpoint directory and is built once per
(session, input folder); queries then read the written tables.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import SparkSession

from daybook.plans import fixture, pipeline
from daybook.session import checkpoint_root, configure, scratch_dir
from daybook.sources import bronze, fs

_BUILT: dict[tuple, tuple[pipeline.Paths, list[str]]] = {}
_LOCK = threading.Lock()


def bronze_dates(spark: SparkSession, root: str) -> list[str]:
    """Arrival dates that have a Bronze folder below ``root`` (one listing)."""
    prefix = "date="
    return [d[len(prefix):] for d in fs.subdirs(spark, root) if d.startswith(prefix)]


def write_fixture_bronze(spark: SparkSession, sf_dir: str, bronze_root: str) -> list[str]:
    """Land the given ``events`` table as Bronze CSV; returns the arrival dates."""
    bronze.write_bronze(fixture.raw(spark, sf_dir), bronze_root, mixed_dates=True)
    return bronze_dates(spark, bronze_root)


def build(spark: SparkSession, sf_dir: str) -> tuple[pipeline.Paths, list[str]]:
    """The warehouse for ``sf_dir`` in this session: built on first use, then reused."""
    configure(spark)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), checkpoint_root(spark))
    with _LOCK:  # queries called from several threads build it once
        hit = _BUILT.get(key)
        if hit and fs.exists(spark, hit[0].mart):
            return hit
        paths = pipeline.Paths.under(scratch_dir(spark, "warehouse"))
        dates = write_fixture_bronze(spark, sf_dir, paths.bronze)
        pipeline.run_dates(spark, paths, dates)
        pipeline.load(spark, paths, dates)
        _BUILT[key] = (paths, dates)
        return paths, dates


def fresh_layers(spark: SparkSession, sf_dir: str) -> tuple[pipeline.Paths, list[str]]:
    """New, empty Silver/Gold/mart folders over the warehouse's Bronze."""
    base, dates = build(spark, sf_dir)
    return pipeline.Paths.under(scratch_dir(spark, "layers"), bronze_root=base.bronze), dates
