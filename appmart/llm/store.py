"""Stored steps whose Python tasks read small Arrow batches.

Rows here hold whole texts, so a batch of the default 10,000 rows can be
large. The shuffle files of a step go as soon as it is written, as nothing
reads them again. The settings apply while the step is written and are put back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from appmart import session

ROWS_PER_BATCH = 1000
_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_PER_BATCH),
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark = df.sparkSession
    with session.kept_settings(spark, *_SETTINGS):
        for key, value in _SETTINGS.items():
            spark.conf.set(key, value)
        return session.materialise(df, label)
