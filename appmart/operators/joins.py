"""Join operators (C1–C7) and the size check that guards every broadcast.

Broadcasting is only ever decided by :func:`fits`, which counts the rows and adds up the
bytes of just what would be sent; a side over a bound takes a shuffle join instead, where
AQE splits partitions made large by a hot key (``spark.sql.adaptive.skewJoin.enabled`` with
``forceOptimizeSkewedJoin``, set by :mod:`appmart.session`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appmart.session import materialise, size_checks

# Rows a side may have to be broadcast. A broadcast table is copied to every
# executor, so the bound is on the copy, not on the data the job reads.
DEFAULT_BROADCAST_ROWS = 500_000
# Bytes its values may have, as rows of long texts can be few and large.
DEFAULT_BROADCAST_BYTES = 64 << 20
# Rows of either side in a block of the NULL-key branch: left rows that are
# eligible, and NULL-key rows; and about the most pairs that a block makes.
ELIGIBLE_CHUNK_ROWS = 100_000
ORPHAN_BUCKET_ROWS = 2_048
BLOCK_PAIRS = 1 << 22
# Keys that a spread join watches for heavy ones, and those it may salt.
SKETCH_ITEMS, HEAVY_KEYS = 4096, 1024


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values: 8 for each number, date or flag, 16 and the octets for each text,
    the octets of the JSON text for anything nested."""
    size = F.lit(0).cast("long")
    for field in schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(value), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 16
        else:
            size = size + 8
    return size


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES,
         columns: Sequence[str] | None = None) -> bool:
    """True when ``df`` (or just its ``columns``) has at most ``max_rows`` rows and ``max_bytes`` bytes of values.

    Both are measured, never estimated: plain sums, one row of figures a task. For a table in
    write-once files the answer is remembered, so checking one dimension for several facts
    runs once. Where the plan reads more than ``max_bytes`` of files the rows are counted first
    (a stored table answers from its footers), so a large table's texts are not read in vain.
    """
    known = size_checks(df)
    question = (tuple(columns) if columns else None, max_rows, max_bytes)
    if known is not None and question in known:
        return known[question]
    sent = df.select(*columns) if columns else df
    result = max_rows > 0
    if result and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > max_bytes:
        result = sent.count() <= max_rows
    if result:
        found = sent.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(sent.schema)).alias("b")).first()
        result = found["n"] <= max_rows and (found["b"] or 0) <= max_bytes
    if known is not None:
        known[question] = result
    return result


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its measured rows and bytes are within the bounds."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def semi_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str = "hash_key",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Keep fact rows whose key exists in the dimension.

    Equal to INNER JOIN + DISTINCT when only the key comes from the
    dimension, without the fan-out a duplicated dimension key would cause.
    """
    keys = dim.select(F.col(dim_key).alias(fact_key))
    if fits(dim, max_broadcast_rows, columns=[dim_key]):      # what is sent are the keys alone
        keys = F.broadcast(keys)
    return fact.join(keys, on=fact_key, how="left_semi")


def lookup_left(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """LEFT JOIN to a lookup table.

    Unmatched rows get NULL attributes; a key duplicated in the lookup fans
    the row out. The lookup is broadcast when its size check passes.
    """
    return df.join(broadcast_if_small(dim, max_broadcast_rows), on=on, how="left")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on shared key columns (C4); a NULL key never matches."""
    return left.join(right, on=list(keys), how="inner")


def join_coalesced_key(left: DataFrame, right: DataFrame, left_cols: Sequence[str],
                       right_col: str, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
                       ) -> DataFrame:
    """Inner join on ``COALESCE(left_cols...) = right_col``.

    The coalesce only reads the left side, so this is an equi-join on a
    derived key: a broadcast join when the right side's size check passes,
    else a hash-partitioned shuffle join; never a nested loop.
    """
    key = F.coalesce(*[left[c] for c in left_cols])
    return left.join(broadcast_if_small(right, max_broadcast_rows), key == right[right_col], "inner")


def join_coalesce_fallback(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                           fallback: Column, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
                           ) -> tuple[DataFrame, bool]:
    """Inner join on ``left_key = COALESCE(right_key, fallback)``.

    ``fallback`` may only reference left columns; the two inputs must have
    disjoint column names. Written as one condition, Spark plans this as a
    Cartesian product. Split by whether the right key is NULL it becomes:

    * non-NULL right keys: an equi-join ``left_key = right_key``;
    * NULL right keys: each such row pairs with every left row where
      ``left_key = fallback``: that product *is* the defined result, all pairs
      by definition. It is formed in blocks of a left chunk and a chunk of
      NULL-key rows, as an equi-join on the two chunk numbers, so each pair
      meets once and a task holds a part of either side. Both sides are
      numbered and stored once: the number of chunks follows their counts, so
      neither a chunk nor a block's pairs grow with the data; equal rows
      spread; and a recomputed task sees the same chunks. The blocks are dealt
      by their number, as the few bytes of their rows say nothing of the pairs
      and would be merged into few tasks. One chunk (broadcast) suffices when
      the NULL-key rows fit the bound.

    Returns ``(joined, had_null_keys)``; with NULL keys present, rows of the
    two branches may coincide, so callers that need set semantics dedupe.
    """
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"inputs share column names {sorted(overlap)}; rename first")
    keyed = right.where(F.col(right_key).isNotNull())
    matched = left.join(broadcast_if_small(keyed, max_broadcast_rows),
                        F.col(left_key) == F.col(right_key), "inner")

    orphans = right.where(F.col(right_key).isNull())
    if orphans.limit(1).count() == 0:
        return matched, False

    eligible = left.where(F.col(left_key) == fallback)
    if fits(orphans, max_broadcast_rows):
        paired = eligible.withColumn("_all", F.lit(0)).join(
            F.broadcast(orphans.withColumn("_all", F.lit(0))), "_all", "inner").drop("_all")
        return matched.unionByName(paired), True
    right_rows, right_chunks = _in_chunks(orphans, "_rc", ORPHAN_BUCKET_ROWS, "orphan-rows")
    per_chunk = max(1, -(-right_rows.count() // right_chunks))
    left_rows, left_chunks = _in_chunks(eligible, "_lc", min(ELIGIBLE_CHUNK_ROWS, max(1, BLOCK_PAIRS // per_chunk)),
                                        "eligible-rows")
    right_rows = right_rows.withColumn("_lc", F.explode(F.sequence(F.lit(0), F.lit(left_chunks - 1))))
    left_rows = left_rows.withColumn("_rc", F.explode(F.sequence(F.lit(0), F.lit(right_chunks - 1))))
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(left_chunks * right_chunks, width)
    paired = left_rows.repartition(tasks, "_lc", "_rc").join(
        right_rows.repartition(tasks, "_lc", "_rc"), ["_lc", "_rc"], "inner").drop("_lc", "_rc")
    return matched.unionByName(paired), True


def _in_chunks(df: DataFrame, column: str, rows: int, label: str) -> tuple[DataFrame, int]:
    """``df`` stored, with ``column`` dealing its rows to chunks of about ``rows``; and the number of chunks."""
    numbered = materialise(df.withColumn("_row", F.monotonically_increasing_id()), label)
    chunks = max(1, -(-numbered.count() // rows))
    # Row numbers run on within a partition and jump between partitions; their hash spreads both.
    return numbered.withColumn(column, F.pmod(F.xxhash64("_row"), F.lit(chunks)).cast("int")).drop("_row"), chunks


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int) -> DataFrame:
    """(_key, _parts): hashes of the keys with more than ``share`` rows, and how many shares they have.

    A mergeable heavy-hitter sketch per task, merged into one of SKETCH_ITEMS counters: its size
    does not grow with the data. Counts are estimates; they choose parts, never rows. A key of
    more than ``share`` rows is missed only if ``share`` is under about 1/SKETCH_ITEMS of all rows.
    """
    item = F.xxhash64(*[F.col(k) for k in keys])
    top = df.select(item.alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {HEAVY_KEYS}, {SKETCH_ITEMS})").alias("top"))
    return top.select(F.explode("top").alias("t")).where(F.col("t.count") > share).select(
        F.col("t.item").alias("_key"), F.ceil(F.col("t.count") / share).cast("int").alias("_parts"))


def join_spread(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str],
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, share: int | None = None) -> DataFrame:
    """Inner equi-join in which the output of a hot key spreads over several tasks.

    The right side is broadcast if its size check passes. Else a sketch of the left side's keys
    (stored first, as it is read twice) names the heavy ones, those of more than ``share`` rows
    (by default an even task's share). Only these are salted: a left row goes to the part its
    ``by`` columns choose, a right row to all parts of its key, of which a key has as many as
    shares. Every other row goes once. AQE's own split looks at input bytes and does not see
    the fan-out of a key with many rows on both sides.
    """
    if fits(right, max_broadcast_rows):
        return left.join(F.broadcast(right), list(keys), "inner")
    left = materialise(left, "spread-left")
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # No smaller than what the sketch tells apart from the rest for certain.
    share = share or max(1, -(-left.count() // min(width, SKETCH_ITEMS // 2)))
    # At most HEAVY_KEYS rows, so their copy on every executor is small whatever the data.
    heavy = materialise(heavy_keys(left, keys, share), "heavy-keys")
    if heavy.isEmpty():
        return left.join(right, list(keys), "inner")
    here, there = salted(left, right, keys, by, heavy)
    return here.join(there, [*keys, "_part"], "inner").drop("_part")


def salted(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str],
           heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_part``: 0, or for heavy keys the part of a left row and every part of a right row."""
    item = F.xxhash64(*[F.col(k) for k in keys])
    parts = F.coalesce(F.col("_parts"), F.lit(1))

    def marked(side: DataFrame, part: Column) -> DataFrame:
        return side.withColumn("_key", item).join(F.broadcast(heavy), "_key", "left").withColumn(
            "_part", part).drop("_key", "_parts")
    return (marked(left, F.pmod(F.xxhash64(*[F.col(c) for c in by]), parts).cast("int")),
            marked(right, F.explode(F.sequence(F.lit(0), parts - 1))))
