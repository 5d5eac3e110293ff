"""Deterministic pseudo-random draws for the synthetic event source.

Each draw is the first 8 hex digits of md5("<date>:<salt>:<id>") read as an
integer in [0, 2^32). Unlike ``rand()`` it does not depend on partitioning or
task retries, so a lost executor recomputes the same rows, and a SQL engine with
``md5`` can reproduce every value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(date_text: str, salt: str, id_col: Column) -> Column:
    """An integer in [0, 2^32) from md5("<date>:<salt>:<id>")."""
    key = F.concat_ws(":", F.lit(date_text), F.lit(salt), id_col.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
