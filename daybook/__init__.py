"""daybook: layered daily event analytics on Spark.

Raw event files land by arrival date (Bronze CSV); they are cleaned into typed,
partitioned Parquet (Silver), aggregated into one metrics row per event date (Gold),
published to a replaceable metrics table (mart) and read by dashboard queries.
Every step is a DataFrame plan; only writers and gates run actions.
"""

from daybook.session import get_session, configure, scratch_dir

__version__ = "0.1.0"

__all__ = ["get_session", "configure", "scratch_dir", "__version__"]
