"""trendlake: a Spark-native medallion pipeline for periodic popularity snapshots.

Bronze (raw nested JSON envelopes) -> Silver (typed, cleaned, deduplicated facts and a
category dimension) -> data-quality gate -> Gold (four aggregate tables) -> analyst SQL.

Every transformation is a plain ``DataFrame -> DataFrame`` function built from Spark's
built-in operators; only the modules under ``sinks`` and ``plans.jobs`` perform I/O.
"""

from trendlake.session import get_spark, prepare_session, scratch_dir

__all__ = ["get_spark", "prepare_session", "scratch_dir"]
