"""Per-table load statistics (G14): row count, exact distinct-row count, duration."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appmart import functions as fn
from appmart.operators import row_stats
from appmart.operators.projection import ETL_COLUMN
from appmart.schemas import STATISTICS_SCHEMA


def statistics_frame(df: DataFrame, table_name: str, etl_ts: str,
                     dag_execution_date: str | None = None) -> DataFrame:
    """The deterministic columns of a statistics row, as a one-row DataFrame.

    ``df`` carries one run timestamp in all rows, so that column takes no part in the count.
    """
    stats = row_stats(df, constant=[ETL_COLUMN])
    dag = fn.ts_literal(dag_execution_date) if dag_execution_date else F.lit(None).cast("timestamp")
    return stats.select(
        F.lit(table_name).alias("table_name"),
        dag.alias("dag_execution_date"),
        fn.ts_literal(etl_ts).alias("etl_timestamp"),
        F.col("row_count").alias("row_loaded_to_bq"),
        F.col("distinct_row_count").alias("distinct_row_loaded_to_bq"),
    )


def _instant(text: str | None) -> datetime | None:
    if text is None:
        return None
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


def load_statistics(spark: SparkSession, table: DataFrame, table_name: str, started: float,
                    etl_ts: str, dag_execution_date: str | None = None) -> tuple[DataFrame, int]:
    """The full statistics row of a just-written table, and its row count.

    ``load_to_bq_timestamp`` is taken when counting starts; the duration runs
    from ``started`` (a ``time.time()`` value) to after the distinct count,
    rounded to 2 decimals of a minute. Only the one aggregate row reaches
    the driver.
    """
    loaded_at = datetime.now(timezone.utc)
    counts = row_stats(table, constant=[ETL_COLUMN]).first()
    duration = round((time.time() - started) / 60, 2)
    row = (table_name, _instant(dag_execution_date), loaded_at, _instant(etl_ts), float(duration),
           int(counts["row_count"]), int(counts["distinct_row_count"]))
    return spark.createDataFrame([row], STATISTICS_SCHEMA), row[-2]
