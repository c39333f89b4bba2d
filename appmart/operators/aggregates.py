"""Distinct, grouping, counting and set operators.

Every aggregate here is a built-in Spark aggregate, so it runs as a partial
(map-side) aggregate, a shuffle of the partial results, and a final merge. A
key that holds a large share of the rows is therefore collapsed inside each
map task before anything moves; no group is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appmart.operators.joins import broadcast_if_small
from appmart.session import materialise


def distinct_rows(df: DataFrame) -> DataFrame:
    """SELECT DISTINCT over all columns (D1). NULLs compare equal here."""
    return df.distinct()


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """UNION DISTINCT of positionally matching inputs.

    One distinct after a positional union equals pairwise UNION DISTINCT and
    costs one shuffle instead of one per branch.
    """
    if not dfs:
        raise ValueError("union_distinct needs at least one input")
    width = len(dfs[0].columns)
    for d in dfs[1:]:
        if len(d.columns) != width:
            raise ValueError("UNION inputs must have the same number of columns")
    return reduce(DataFrame.union, dfs).distinct()


def group_avg(df: DataFrame, by: str | Column, metrics: Mapping[str, str],
              round_to: int | None = 2, null_as: float | None = 0.0) -> DataFrame:
    """Per-group unweighted mean of each metric.

    ``metrics`` maps output name → input column. NULL inputs are skipped; an
    all-NULL group averages to ``null_as``; results are rounded half away
    from zero to ``round_to`` places. A NULL grouping key is a group.
    """
    aggs = []
    for out, src in metrics.items():
        value = F.avg(F.col(src))
        if null_as is not None:
            value = F.coalesce(value, F.lit(float(null_as)))
        if round_to is not None:
            value = F.round(value, round_to)
        aggs.append(value.alias(out))
    return df.groupBy(by).agg(*aggs)


def count_rows(df: DataFrame) -> DataFrame:
    """COUNT(*) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_row_count(df: DataFrame) -> DataFrame:
    """Exact number of distinct rows over all columns, one row.

    Exact by definition of the statistic: never an approximate sketch.
    """
    return df.distinct().agg(F.count(F.lit(1)).alias("distinct_row_count"))


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit digests of a row. NULL flags are part of them, as hashes pass over NULLs."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


DIGESTS = ("_digest1", "_digest2")


def _digests(columns: Sequence[str]) -> list[Column]:
    return [d.alias(name) for d, name in zip(row_digest(columns), DIGESTS)]


def digest_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows (``_n``) have each digest of ``columns``."""
    return df.select(*_digests(columns)).groupBy(*DIGESTS).agg(F.count(F.lit(1)).alias("_n"))


def row_stats(df: DataFrame, constant: Collection[str] = ()) -> DataFrame:
    """Row count and exact distinct-row count.

    What is shuffled are 16-byte digests with their counts (partial sums per task), not rows.
    Equal rows have equal digests, so a digest counted once is one distinct row; a table without
    equal rows, such as any built by DISTINCT, is done with that. Else the rows whose digest
    repeats are compared in full: their digests are stored, pick them out, and DISTINCT counts
    them. Exact therefore, whatever digests clash. ``constant`` names columns that hold one value
    in all rows, such as the run timestamp; they take no part. An empty input gives (0, 0). The
    digests are counted at the call.
    """
    names = [c for c in df.columns if c not in set(constant)]
    groups = digest_groups(df, names)
    seen = groups.agg(F.sum("_n").alias("rows"), F.count_if(F.col("_n") == 1).alias("once")).first()
    rows, once = seen["rows"] or 0, seen["once"]
    if rows == once:
        return df.sparkSession.range(1).select(F.lit(rows).cast("long").alias("row_count"),
                                               F.lit(once).cast("long").alias("distinct_row_count"))
    repeated = materialise(groups.where("_n > 1").select(*DIGESTS), "repeated-digests")
    again = df.select(*_digests(names), *names).join(
        broadcast_if_small(repeated), list(DIGESTS), "left_semi").select(*(names or DIGESTS)).distinct()
    return again.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(rows).cast("long").alias("row_count"),
        (F.col("_n") + F.lit(once)).cast("long").alias("distinct_row_count"))
