"""Benchmark decontamination by SimHash over item-sized windows.

Words are lower-cased runs of letters and digits, shingles five words. A
document window as long as a benchmark item leaks it if their shingle
multisets have a weighted Jaccard similarity (multiplicities as weights) of
at least 0.8. A document shorter than the item is one window, the whole text.

Such a window must hold at least 0.8 of the item's shingle count from items of
that size, so only windows that dense are fingerprinted (a lossless cut:
nothing else can be similar). Fingerprints are 64-bit SimHashes in eight blocks;
items are indexed under every block value with up to two flipped bits, so by
pigeonhole a lookup of the eight blocks finds *all* items within RADIUS bits.
RADIUS is the most that the blocks cover, over four standard deviations above
the distance expected at similarity 0.8. The survivors are verified exactly.

Built-in expressions only. The item shingles are broadcast only below a
checked count; beyond it the same join shuffles.

Defined results: null or empty texts hold no leak; equal texts share one
verdict and are searched once; an item of fewer than five words cannot be
leaked; repeated items are one; empty tables give no leaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .store import materialise

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_ERRORS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_ERRORS + 1) - 1  # 23, all that the blocks cover
#: Most rows (of two longs) that a broadcast side may have.
BROADCAST_ROWS = 1_000_000


def text_key(text: Column) -> Column:
    """128-bit key of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def with_shingles(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` without ``text``, plus ``out``: shingle hashes in order."""
    kept = [c for c in rows.columns if c != text]
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    found = F.filter(F.split(lowered, r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))
        runs = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
        return F.when(F.size(w) >= SHINGLE, runs).otherwise(F.array().cast("array<bigint>"))
    # The one-element transform binds the words, so they are split once a row wherever the optimiser moves this.
    return rows.select(*kept, F.get(F.transform(F.array(found), hashed), F.lit(0)).alias(out))


def _small(df: DataFrame) -> DataFrame:
    """``df`` (stored), marked for broadcast if its row count is below the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _fingerprint(h: str) -> list[Column]:
    """One aggregate per block: the majority bits of the hashes in column ``h``."""
    blocks = []
    for b in range(BLOCKS):
        bits = [F.when(F.sum(F.getbit(F.col(h), F.lit(BLOCK_BITS * b + i)).cast("int") * 2 - 1) >= 0, 1 << i).otherwise(0)
                for i in range(BLOCK_BITS)]
        total = bits[0]
        for bit in bits[1:]:
            total = total + bit
        blocks.append(total.alias(f"b{b}"))
    return blocks


def _flips() -> list[int]:
    """All block masks of at most BLOCK_ERRORS bits."""
    return [m for m in range(1 << BLOCK_BITS) if bin(m).count("1") <= BLOCK_ERRORS]


def _needed(m: Column) -> Column:
    """Least number of matching shingles of a window of ``m``."""
    return F.ceil(F.lit(SIMILARITY) * m - 1e-9).cast("int")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, start, n, similarity): leaked items of each distinct text, the best window of each.

    ``docs`` needs ``text``, ``benchmark`` item_id and text. ``key`` is
    ``text_key``; start counts shingles from 0, n is the window's shingle count.
    """
    items = materialise(with_shingles(benchmark.select("item_id", "text"), "text", "ih")
                        .distinct().withColumn("m", F.size("ih")), "decon-items").filter("m > 0")
    known = materialise(items.select("m", F.explode("ih").alias("h")).distinct(), "decon-shingles")
    texts = docs.select(text_key(F.col("text")).alias("key"), "text")
    # Positions of shingles that some item of size m holds. Equal texts merge before the shuffle.
    hits = (with_shingles(texts, "text", "dh").select("key", F.posexplode_outer("dh").alias("pos", "h"))
            .join(_small(known), "h").groupBy("key", "m").agg(F.sort_array(F.collect_set("pos")).alias("p")))
    # A dense window spans some c consecutive hits within m positions; these are all its possible starts.
    c = _needed(F.col("m"))
    dense = hits.filter(F.size("p") >= c).withColumn("c", c).select("key", "m", F.explode(F.expr("""
        filter(transform(sequence(0, size(p) - c), i -> struct(p[i] as first, p[i + c - 1] as last)),
               x -> x.last - x.first < m)""")).alias("x"))
    windows = materialise(dense.select("key", "m", F.explode(F.expr(
        "sequence(greatest(x.last - m + 1, 0), x.first)")).alias("start")).distinct(), "decon-windows")
    keys = materialise(windows.select("key").distinct(), "decon-keys")
    held = materialise(with_shingles(texts.join(_small(keys), "key", "left_semi"), "text", "dh")
                       .dropDuplicates(["key"]), "decon-texts")
    cut = windows.join(held, "key").select("key", "m", "start", F.expr("slice(dh, start + 1, m)").alias("wh"))
    # A text shorter than the item is its own window; one that cannot hold 0.8 of the item had no dense window.
    cut = materialise(cut.filter((F.size("wh") == F.col("m")) | (F.col("start") == 0)), "decon-cut")

    def fingerprints(rows: DataFrame, keys: list[str], hashes: str) -> DataFrame:
        return rows.select(*keys, F.explode(hashes).alias("h")).groupBy(*keys).agg(*_fingerprint("h"))

    def by_block(prints: DataFrame, keys: list[str], masks: list[int]) -> DataFrame:
        blocks = F.array(*[F.struct(F.lit(b).alias("no"), F.col(f"b{b}").alias("v")) for b in range(BLOCKS)])
        return (prints.select("*", F.explode(blocks).alias("block"))
                .select("*", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
                .select(*keys, *[f"b{b}" for b in range(BLOCKS)], F.col("block.no").alias("no"),
                        F.col("block.v").bitwiseXOR(F.col("mask")).alias("v")))
    w = by_block(fingerprints(cut, ["key", "m", "start"], "wh"), ["key", "m", "start"], [0]).alias("w")
    i = by_block(fingerprints(items, ["item_id", "m"], "ih"), ["item_id", "m"], _flips()).alias("i")
    apart = sum((F.bit_count(F.col(f"w.b{b}").bitwiseXOR(F.col(f"i.b{b}"))) for b in range(BLOCKS)), F.lit(0))
    near = w.join(i, (F.col("w.m") == F.col("i.m")) & (F.col("w.no") == F.col("i.no")) & (F.col("w.v") == F.col("i.v")))
    near = near.filter(apart <= RADIUS).select("w.key", "w.m", "w.start", "i.item_id").distinct()
    both = near.join(cut, ["key", "m", "start"]).join(items, ["item_id", "m"])
    shared = F.expr("""aggregate(transform(array_distinct(ih), h -> least(
        size(filter(ih, x -> x = h)), size(filter(wh, x -> x = h)))), 0, (a, x) -> a + x)""")
    scored = both.select("key", "item_id", "start", F.size("wh").alias("n"),
                         (shared / (F.size("wh") + F.col("m") - shared)).alias("similarity"))
    best = F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("s"), F.col("n")))
    return (scored.filter(F.col("similarity") >= SIMILARITY).groupBy("key", "item_id").agg(best.alias("x"))
            .select("key", "item_id", (-F.col("x.s")).alias("start"), F.col("x.n").alias("n"), "x.similarity"))


def judge(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``d`` (struct of ``keep``, by default all columns) and ``items``
    (sorted ids of leaked items, empty for a clean text)."""
    keep = docs.columns if keep is None else keep
    leaks = materialise(find_leaks(docs, benchmark).groupBy("key").agg(
        F.sort_array(F.collect_set("item_id")).alias("items")), "decon-leaks")
    rows = docs.select(F.struct(*keep).alias("d"), text_key(F.col("text")).alias("key"))
    return rows.join(_small(leaks), "key", "left").select("d", F.coalesce(
        "items", F.array().cast("array<bigint>")).alias("items"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    return judge(docs, benchmark).filter(F.size("items") == 0).select("d.*")
