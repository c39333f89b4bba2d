"""Uniform shuffle into shards of exact sizes.

The rows of P input partitions go to K shards whose row counts differ by at
most one. How many rows partition p sends to shard k is drawn first: a P x K
communication matrix, row by row from the multivariate hypergeometric law
given what is left of each shard. Then every partition permutes its rows
locally and cuts them by its matrix row, the rows are exchanged, and every
shard permutes again. The result is a uniform random placement; no sort of
the whole table and no shard count that is off.

Only counts reach the driver: P x K integers, independent of the row count.
Within a shard, ranks are taken per random bucket of bounded expected size
plus the bucket's offset, so no task ranks a whole shard.

Defined results: null ids and texts, repeated rows and equal texts are plain
rows and are placed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .store import materialise

SEED = 20240229
#: Rows of a shard that one task permutes, about.
ROWS_PER_BUCKET = 200_000


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One draw; beyond numpy's range of 1e9 by inversion outward from the mode
    (log ratios of neighbouring probabilities, within 12 standard deviations)."""
    total = good + bad
    if draws == 0 or good == 0:
        return 0
    if bad == 0 or draws == total:
        return min(draws, good)
    if total < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    mode = (draws + 1) * (good + 1) // (total + 2)
    sd = (draws * (good / total) * (bad / total) * ((total - draws) / (total - 1))) ** 0.5
    lo, hi = max(0, draws - bad, int(mode - 12 * sd) - 2), min(good, draws, int(mode + 12 * sd) + 2)
    k = np.arange(lo, hi, dtype=np.float64)
    step = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(step)])
    cumulative = np.cumsum(np.exp(weight - weight.max()))
    return lo + int(np.searchsorted(cumulative, rng.random() * cumulative[-1], side="right"))


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows partition p sends to shard k; row sums are ``counts``, column sums
    differ by at most one."""
    rng = np.random.default_rng(seed)
    total = sum(counts)
    room = [total // shards + (k < total % shards) for k in range(shards)]
    matrix = []
    for n in counts:
        row, left, space = [], n, sum(room)
        for k in range(shards):
            x = _hypergeometric(rng, room[k], space - room[k], left)
            row.append(x)
            left -= x
            space -= room[k]
        room = [a - b for a, b in zip(room, row)]
        matrix.append(row)
    return matrix


def place(stored: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``rid``, ``shard`` (int) and ``slot`` (long, gapless from 0 in a shard) for the
    rows of a stored table with a unique ``rid`` and the partition ``part`` it came from."""
    spark = stored.sparkSession
    counts = sorted((r["part"], r["n"]) for r in stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    bounds = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(row)]) for (p, _), row in zip(counts, matrix)], "part int, ends array<bigint>")
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "rid"), "rid")
    ranked = stored.select("part", "rid", (F.row_number().over(local) - 1).cast("long").alias("_rank"))
    largest = -(-sum(n for _, n in counts) // shards)
    buckets = max(1, -(-largest // ROWS_PER_BUCKET))
    sent = ranked.join(bounds, "part").select(
        "rid",
        F.expr("size(filter(ends, e -> e <= _rank))").cast("int").alias("shard"),
        F.xxhash64(F.lit(seed + 1), "rid").alias("_order"),
    ).withColumn("_bucket", F.pmod(F.col("_order"), F.lit(buckets)))
    if buckets == 1:
        offsets, first = sent, F.lit(0)
    else:
        before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sent.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        offsets = sent.join(sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0))
                                         .alias("_first")), ["shard", "_bucket"])
        first = F.col("_first")
    again = Window.partitionBy("shard", "_bucket").orderBy("_order", "rid")
    return offsets.select("rid", "shard", (first + F.row_number().over(again) - 1).cast("long").alias("slot"))


def shard_rows(df: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """All rows of ``df`` as ``d`` (a struct of its columns) with ``shard`` and ``slot``.

    The rows are stored once in the shared folder with their partition and a
    row number; the placement is a function of the stored copy alone, so a
    recomputed task places its rows as before. Placement moves only row
    numbers; the payload moves once, in the join.
    """
    stored = materialise(df.select(F.struct("*").alias("d"), F.spark_partition_id().alias("part"),
                                   F.monotonically_increasing_id().alias("rid")), "sharding-rows")
    return stored.select("d", "rid").join(place(stored, shards, seed), "rid").select("d", "shard", "slot")
