"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c) -> Column:
    """Text → timestamp with Spark's cast rules; malformed text → NULL (never raises)."""
    return F.try_to_timestamp(_col(c))


def day_name(c) -> Column:
    """Date → short English day name, Mon … Sun."""
    return F.date_format(_col(c), "E")


def layout_columns(date_col="process_date") -> dict[str, Column]:
    """Zero-padded year / month / day text for the directory layout."""
    d = _col(date_col)
    return {"year": F.date_format(d, "yyyy"),
            "month": F.date_format(d, "MM"),
            "day": F.date_format(d, "dd")}


def process_date_from_layout() -> Column:
    """Inverse of :func:`layout_columns` on partition columns read as integers.

    Integer arithmetic per row, no text parsing: the partition values are
    constant per file and typed once by the read schema.
    """
    return F.make_date(F.col("year"), F.col("month"), F.col("day"))
