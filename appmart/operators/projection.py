"""Projection-level operators: select, rename, run-timestamp stamping, conform."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appmart import functions as fn

ETL_COLUMN = "etl_timestamp"


def project(df: DataFrame, *cols: str) -> DataFrame:
    """Keep only ``cols`` (B1); Catalyst prunes the rest down to the scan."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns old→new in one projection (B2), keeping column order."""
    missing = set(mapping) - set(df.columns)
    if missing:
        raise KeyError(f"cannot rename missing columns {sorted(missing)}")
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def stamp(df: DataFrame, etl_ts: str, column: str = ETL_COLUMN) -> DataFrame:
    """Set the run timestamp on every row.

    Added in the same projection that is written, so no table is ever visible
    unstamped and no second pass over the data is needed.
    """
    return df.withColumn(column, fn.ts_literal(etl_ts))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, in its order, cast to its types."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise KeyError(f"input lacks columns {missing} required by the target schema")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
