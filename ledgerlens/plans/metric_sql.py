"""A user's metric statement over silver frames (F8).

For users who keep metrics as SQL text: ``:run_date`` is bound by Spark
(``spark.sql(text, args=...)``), never by string replacement, and the frames
are passed as arguments under the names the statement uses in braces, so no
temporary view name can clash between sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def metric_sql(spark: SparkSession, statement: str, run_date: str, **frames: DataFrame) -> DataFrame:
    """Run ``statement`` with ``:run_date`` bound and ``{name}`` standing for
    the frame of that name."""
    return spark.sql(statement, args={"run_date": run_date}, **frames)
