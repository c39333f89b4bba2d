"""Key-quality checks: the declared-but-unenforced constraints, made checkable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appmart.operators.joins import DEFAULT_BROADCAST_ROWS, fits


def pk_duplicates(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur on more than one row, with their row count.

    A partial aggregate per map task counts each key before the shuffle, so
    a key holding most rows still moves one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def fk_orphans(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str = "hash_key") -> DataFrame:
    """Fact rows whose foreign key has no row in the dimension.

    A NULL foreign key has no match, so it is reported as an orphan. The
    dimension's keys are broadcast when their measured size allows (a key listed
    twice does not change an anti join, so no distinct is needed).
    """
    keys = dim.select(F.col(dim_key).alias("_dim_key"))
    if fits(dim, DEFAULT_BROADCAST_ROWS, columns=[dim_key]):    # what is sent are the keys alone
        keys = F.broadcast(keys)
    return fact.join(keys, fact[fk] == keys["_dim_key"], "left_anti")
