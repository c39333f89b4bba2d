"""Generic operators: projection, distinct/union, aggregates, joins, key checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from appmart import operators as ops
from appmart.operators import joins


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# --- projection ---------------------------------------------------------------

def test_rename_keeps_order_and_rejects_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "userID int, sku int, orderID int")
    out = ops.rename(df, {"userID": "user_id", "orderID": "order_id"})
    assert out.columns == ["user_id", "sku", "order_id"]
    with pytest.raises(KeyError):
        ops.rename(df, {"nope": "x"})


def test_stamp_sets_one_value_on_all_rows(spark):
    df = spark.range(5)
    out = ops.stamp(df, "2024-02-01T06:30:00+00:00")
    values = {r["etl_timestamp"] for r in out.select(F.col("etl_timestamp").cast("string")).collect()}
    assert values == {"2024-02-01 06:30:00"}


def test_conform_selects_and_casts(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    df = spark.createDataFrame([(1, 2, "x")], "a int, b int, c string")
    out = ops.conform(df, schema)
    assert out.schema == schema
    assert out.first() == (2, "1")
    with pytest.raises(KeyError):
        ops.conform(df.drop("b"), schema)


# --- distinct, union, counts ----------------------------------------------------

def test_distinct_rows_groups_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", None), ("a", None), ("a", 2)], "s string, n int")
    assert ops.distinct_rows(df).count() == 3


def test_union_distinct_is_positional(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1)], "p string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "q string, w int")
    out = ops.union_distinct(a, b)
    assert out.columns == ["p", "v"]
    assert rows(out) == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        ops.union_distinct(a, spark.range(1))


def test_row_stats_counts_rows_and_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "i int, s string")
    r = ops.row_stats(df).first()
    assert (r["row_count"], r["distinct_row_count"]) == (5, 3)
    assert ops.count_rows(df).first()["row_count"] == 5
    assert ops.distinct_row_count(df).first()["distinct_row_count"] == 3


def test_row_stats_of_empty_table(spark):
    df = spark.createDataFrame([], "i int, s string")
    r = ops.row_stats(df).first()
    assert (r["row_count"], r["distinct_row_count"]) == (0, 0)


def _row_stats(df, **more):
    r = ops.row_stats(df, **more).first()
    return r["row_count"], r["distinct_row_count"]


def test_row_stats_tells_apart_what_hashes_pass_over(spark):
    rows_ = [("a", None), (None, "a"), (None, None), ("", None), (None, ""), ("a", None)]
    assert _row_stats(spark.createDataFrame(rows_, "s string, t string")) == (6, 5)
    nan = float("nan")
    numbers = spark.createDataFrame([(0.0,), (-0.0,), (nan,), (nan,), (None,)], "d double")
    assert _row_stats(numbers) == (5, numbers.distinct().count()) == (5, 3)
    nested = spark.createDataFrame([([None, "a"],), (["a", None],), (["a"],)], "a array<string>")
    assert _row_stats(nested) == (3, 3)


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_row_stats_is_exact_when_digests_clash(spark, monkeypatch, broadcast_rows):
    from appmart.operators import aggregates
    real = aggregates.row_digest
    monkeypatch.setattr(aggregates, "row_digest", lambda cols: [F.pmod(real(cols)[0], F.lit(4)), F.lit(0)])
    monkeypatch.setattr(aggregates, "broadcast_if_small", lambda df: ops.broadcast_if_small(df, broadcast_rows))
    df = spark.range(300).select((F.col("id") % 50).alias("i"), (F.col("id") % 3).cast("string").alias("s"))
    assert _row_stats(df) == (300, 150)


def test_row_stats_leaves_constants_out(spark):
    df = spark.createDataFrame([(1, "t"), (1, "t"), (2, "t")], "i int, stamp string")
    assert _row_stats(df, constant=["stamp"]) == (3, 2)
    assert _row_stats(df.select("stamp"), constant=["stamp"]) == (3, 1)
    assert _row_stats(df.select("stamp").limit(0), constant=["stamp"]) == (0, 0)


def test_row_stats_shuffles_digests_not_rows(spark):
    from appmart.operators.aggregates import digest_groups
    df = spark.range(10).select("id", F.repeat(F.lit("text"), 50).alias("long_text"), F.lit("now").alias("stamp"))
    groups = digest_groups(df, ["id", "long_text"])
    groups.write.format("noop").mode("overwrite").save()
    plan = groups._jdf.queryExecution().executedPlan()
    exchange = [x for x in plan.toString().split("\n") if "Exchange hashpartitioning" in x]
    assert exchange and all("_digest1" in x and "_digest2" in x and "long_text" not in x and "stamp" not in x
                            for x in exchange)
    below = plan.toString().split("Exchange hashpartitioning")[1].split("\n")[1]
    assert "keys=[_digest1" in below and "partial_count" in below


def test_group_avg_null_group_null_metric_and_rounding(spark):
    df = spark.createDataFrame(
        [("A", 1.0, None), ("A", 2.0, None), (None, 1.005, 4.0), (None, None, 5.0)],
        "country string, m double, n double")
    out = ops.group_avg(df, "country", {"avg_m": "m", "avg_n": "n"})
    got = {r["country"]: (r["avg_m"], r["avg_n"]) for r in out.collect()}
    assert got == {"A": (1.5, 0.0), None: (1.01, 4.5)}


# --- joins ---------------------------------------------------------------------

def test_fits_is_an_exact_bound(spark):
    df = spark.range(10)
    assert joins.fits(df, 10) and not joins.fits(df, 9)


def test_semi_lookup_does_not_fan_out_on_duplicate_dim_key(spark):
    fact = spark.createDataFrame([("k1", 1), ("k2", 2), (None, 3)], "hash_key string, v int")
    dim = spark.createDataFrame([("k1", "Foo"), ("k1", "foo "), ("k3", "x")], "hash_key string, p string")
    assert rows(ops.semi_lookup(fact, dim, "hash_key")) == [("k1", 1)]
    # the plain inner join fans out
    assert ops.join_on(fact, dim, ["hash_key"]).count() == 2
    # also without the broadcast (size check fails)
    assert rows(ops.semi_lookup(fact, dim, "hash_key", max_broadcast_rows=1)) == [("k1", 1)]


def test_lookup_left_keeps_unmatched_and_fans_out(spark):
    df = spark.createDataFrame([("N1", 1.0), ("N9", 2.0)], "country_code string, v double")
    lookup = spark.createDataFrame([("N1", "A"), ("N1", "A2")], "country_code string, country string")
    out = ops.lookup_left(df, lookup, "country_code")
    assert rows(out, "country_code", "country") == [("N1", "A"), ("N1", "A2"), ("N9", None)]


def test_join_on_null_keys_never_match(spark):
    a = spark.createDataFrame([("k", None), ("k", "u1")], "hash_key string, user_id string")
    b = spark.createDataFrame([("k", None), ("k", "u1")], "hash_key string, user_id string")
    assert rows(ops.join_on(a, b, ["hash_key", "user_id"])) == [("k", "u1")]


def test_join_coalesced_key(spark):
    left = spark.createDataFrame([("a", None), (None, "b"), (None, None)], "x string, y string")
    right = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = ops.join_coalesced_key(left, right, ["x", "y"], "k")
    assert rows(out, "k", "v") == [("a", 1), ("b", 2)]


def _naive_fallback(spark, left, right):
    left.createOrReplaceTempView("l_naive")
    right.createOrReplaceTempView("r_naive")
    with_cross = spark.conf.get("spark.sql.crossJoin.enabled")
    spark.conf.set("spark.sql.crossJoin.enabled", "true")
    try:
        return spark.sql("SELECT * FROM l_naive JOIN r_naive "
                         "ON l_naive.lk = COALESCE(r_naive.rk, l_naive.fb)").collect()
    finally:
        spark.conf.set("spark.sql.crossJoin.enabled", with_cross)


@pytest.mark.parametrize("bucket_rows,broadcast_rows", [(100_000, 500_000), (100_000, 0), (2, 0), (1, 0)])
def test_join_coalesce_fallback_equals_naive_form(spark, monkeypatch, bucket_rows, broadcast_rows):
    monkeypatch.setattr(joins, "ORPHAN_BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(joins, "ELIGIBLE_CHUNK_ROWS", bucket_rows)
    left = spark.createDataFrame(
        [("k1", "k1", 1), ("k1", "k2", 2), ("k2", "k2", 3), (None, None, 4), ("k3", None, 5)],
        "lk string, fb string, lid int")
    right = spark.createDataFrame(
        [("k1", 10), ("k2", 20), (None, 30), (None, 31), (None, 32), ("k9", 40)],
        "rk string, rid int")
    got, had_null = ops.join_coalesce_fallback(left, right, "lk", "rk", F.col("fb"),
                                               max_broadcast_rows=broadcast_rows)
    assert had_null
    key = lambda r: (r["lid"], r["rid"])
    assert sorted(map(key, got.collect())) == sorted(map(key, _naive_fallback(spark, left, right)))


def test_join_coalesce_fallback_spreads_equal_rows_of_both_sides(spark, monkeypatch):
    monkeypatch.setattr(joins, "ORPHAN_BUCKET_ROWS", 50)
    monkeypatch.setattr(joins, "ELIGIBLE_CHUNK_ROWS", 20)
    left = spark.createDataFrame([("k", "k", 1)] * 120, "lk string, fb string, lid int")
    right = spark.createDataFrame([(None, 7)] * 400, "rk string, rid int")
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got, _ = ops.join_coalesce_fallback(left, right, "lk", "rk", F.col("fb"), max_broadcast_rows=0)
        shares = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)
    # 6 x 8 blocks of about 20 x 50 pairs over 8 partitions, though all rows of a side are equal.
    assert sum(shares) == 120 * 400 and max(shares) < 120 * 400 / 2


def test_join_coalesce_fallback_makes_its_pairs_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK_PAIRS", 10_000, raising=False)
    left = spark.range(3000).selectExpr("'k' as lk", "'k' as fb", "id as lid")
    right = spark.range(300).selectExpr("cast(null as string) as rk", "id as rid")
    got, _ = ops.join_coalesce_fallback(left, right, "lk", "rk", F.col("fb"), max_broadcast_rows=0)
    found = got.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("lid", "rid").alias("kinds")).collect()
    # Both sides are far below a chunk and a few bytes only; their 900,000 pairs are many.
    assert sum(r["n"] for r in found) == sum(r["kinds"] for r in found) == 900_000
    assert max(r["n"] for r in found) <= 300_000


def test_chunks_follow_the_row_count(spark):
    for rows_, chunks in ((0, 1), (10, 1), (11, 2), (95, 10)):
        df, n = joins._in_chunks(spark.range(rows_), "_c", 10, "chunks")
        assert n == chunks and df.count() == rows_ and df.where(f"_c < 0 or _c >= {chunks}").count() == 0


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_join_spread_equals_plain_join(spark, broadcast_rows):
    left = spark.createDataFrame([("hot", u) for u in range(60)] + [("k1", 1), (None, 2)], "k string, u int")
    right = spark.createDataFrame([("hot", r) for r in range(5)] + [("k1", 9), ("k1", 9), (None, 3)], "k string, r int")
    got = ops.join_spread(left, right, ["k"], ["u"], max_broadcast_rows=broadcast_rows)
    want = left.join(right, "k")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_join_spread_divides_a_hot_key(spark):
    left = spark.createDataFrame([("hot", u) for u in range(800)], "k string, u int")
    right = spark.createDataFrame([("hot", r) for r in range(5)], "k string, r int")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = ops.join_spread(left, right, ["k"], ["u"], max_broadcast_rows=0)
        shares = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(shares) == 4000 and max(shares) <= 1600


def test_only_heavy_keys_are_salted(spark):
    left = spark.createDataFrame([("hot", u) for u in range(900)] + [(f"k{u}", u) for u in range(300)], "k string, u int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{u}", u) for u in range(400)] + [(None, 3)], "k string, r int")
    heavy = joins.heavy_keys(left, ["k"], 150)
    assert [r["_parts"] for r in heavy.collect()] == [6]
    here, there = joins.salted(left, right, ["k"], ["u"], heavy)
    copies = {r["k"]: r["count"] for r in there.groupBy("k").count().collect()}
    assert copies.pop("hot") == 2 * 6 and set(copies.values()) == {1} and len(copies) == 401
    parts = here.where("k = 'hot'").groupBy("_part").count().collect()
    assert len(parts) == 6 and here.where("k != 'hot' and _part != 0").count() == 0
    got = ops.join_spread(left, right, ["k"], ["u"], max_broadcast_rows=0, share=150)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    # No heavy key: a plain join.
    plain = ops.join_spread(left, right, ["k"], ["u"], max_broadcast_rows=0, share=2000)
    assert plain.count() == got.count() and "_part" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_few_very_long_rows_take_the_shuffle(spark):
    from appmart.session import materialise
    short = spark.range(20).select("id", F.lit("x").alias("note"))
    long_ = spark.range(20).select("id", F.repeat(F.lit("long text "), 20_000).alias("note"))
    assert joins.fits(short, 100, 1 << 20) and not joins.fits(long_, 100, 1 << 20)
    assert joins.fits(long_, 100, 4 << 20) and joins.fits(long_, 100, 1 << 20, columns=["id"])
    # Files of repeated text are small; what would be sent is not. A frame made of a stored one is measured itself.
    stored = materialise(long_, "long-rows")
    assert not joins.fits(stored, 100, 1 << 20) and not joins.fits(stored.where("id < 15"), 100, 1 << 20)
    assert joins.fits(stored.where("id < 2"), 100, 1 << 20) and joins.fits(stored, 100, 1 << 20, columns=["id"])
    nested = spark.range(20).select("id", F.array_repeat(F.lit("abc"), 50_000).alias("a"))
    assert not joins.fits(nested, 100, 1 << 20)
    facts_ = spark.range(100).withColumn("v", F.lit(1))
    hint = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hint(facts_.join(joins.broadcast_if_small(short, 100, 1 << 20), "id"))
    assert "broadcast" not in hint(facts_.join(joins.broadcast_if_small(stored, 100, 1 << 20), "id"))


def test_join_coalesce_fallback_without_null_keys_is_equi_join(spark):
    left = spark.createDataFrame([("k1", "k1", 1)], "lk string, fb string, lid int")
    right = spark.createDataFrame([("k1", 10)], "rk string, rid int")
    got, had_null = ops.join_coalesce_fallback(left, right, "lk", "rk", F.col("fb"))
    assert not had_null and got.count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_join_coalesce_fallback_rejects_shared_names(spark):
    a = spark.createDataFrame([("k",)], "k string")
    with pytest.raises(ValueError):
        ops.join_coalesce_fallback(a, a, "k", "k", F.col("k"))


# --- key checks ------------------------------------------------------------------

def test_pk_duplicates(spark):
    df = spark.createDataFrame([("k1", "Foo"), ("k1", "foo "), ("k2", "x")], "hash_key string, p string")
    assert rows(ops.pk_duplicates(df, "hash_key")) == [("k1", 2)]


def test_fk_orphans_reports_missing_and_null_keys(spark):
    fact = spark.createDataFrame([("k1", 1), ("k2", 2), (None, 3)], "hash_key string, v int")
    dim = spark.createDataFrame([("k1",)], "hash_key string")
    assert rows(ops.fk_orphans(fact, dim, "hash_key")) == [("k2", 2), (None, 3)]


def test_size_check_of_a_stored_table_runs_once(spark):
    from appmart.session import materialise
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def jobs(group, check):
        sc.setJobGroup(group, group)
        try:
            check()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    stored, lazy = materialise(spark.range(10), "size-check"), spark.range(10)
    assert jobs("stored-first", lambda: joins.fits(stored, 10)) >= 1
    assert jobs("stored-again", lambda: joins.fits(stored, 10)) == 0
    assert jobs("stored-new-bound", lambda: joins.fits(stored, 9)) >= 1
    assert joins.fits(stored, 10) and not joins.fits(stored, 9)
    assert jobs("lazy-first", lambda: joins.fits(lazy, 10)) >= 1
    assert jobs("lazy-again", lambda: joins.fits(lazy, 10)) >= 1      # lazy inputs may change
