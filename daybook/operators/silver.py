"""Bronze → Silver cleaning (typed, keyed, dated rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_name, parse_event_time
from daybook.schema import BRONZE_COLUMNS, KEY_COLUMNS

_PARSED = "_parsed_ts"


def keys_present(parsed_ts: Column) -> Column:
    """True when every key is set: id, user, product and a parseable timestamp.

    ``amount`` and ``event_type`` are not keys. Never NULL itself, so its
    negation is exactly the set of rows cleaning drops.
    """
    cond = parsed_ts.isNotNull()
    for c in KEY_COLUMNS:
        if c != "event_timestamp":
            cond = cond & F.col(c).isNotNull()
    return cond


def transform_to_silver(bronze: DataFrame) -> DataFrame:
    """Keep keyed rows; the timestamp becomes typed and gives the event date and day name.

    Columns that are not Bronze columns (``process_date`` from the directory) are
    carried through. Narrow only (no shuffle): rows stay in the task that read
    them.
    """
    carried = [c for c in bronze.columns if c not in BRONZE_COLUMNS]
    ts = F.col(_PARSED)
    event_date = F.to_date(ts)
    return (bronze.withColumn(_PARSED, parse_event_time("event_timestamp"))
            .where(keys_present(ts))
            .select("event_id", "user_id", "event_type", "product_id", "amount",
                    ts.alias("event_timestamp"),
                    event_date.alias("event_date"),
                    day_name(event_date).alias("day_of_week"),
                    *carried))


def rejected(bronze: DataFrame) -> Column:
    """True for a Bronze row that cleaning drops."""
    return ~keys_present(parse_event_time("event_timestamp"))
