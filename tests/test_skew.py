"""A hot key holding a third of the rows: results stay exact and AQE splits it.

Spark's skew thresholds are shrunk for the test so that a hot key in small
data counts as skewed; the installs ⋈ trials shuffle join of the merged mart
must then run as a split skew join, and the mart must equal a brute-force
evaluation of its definition.
"""

from __future__ import annotations

import contextlib
from itertools import product

from appmart.plans import marts

ETL = "2024-02-01T06:30:00+00:00"
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def inputs():
    # One hot (key, user): 3000 install rows (distinct campaigns) of about 9000.
    installs = [("hot", "u0", f"c{i}") for i in range(3000)]
    installs += [(f"k{i % 300}", f"u{i % 7}", f"c{i % 11}") for i in range(6000)]
    trials = [("hot", "u0", f"o{i}") for i in range(3)]
    trials += [(f"k{i % 300}", f"u{i % 7}", f"o{i}") for i in range(2100)]
    ratings = [("hot", 5), ("hot", 4)] + [(f"k{i}", 1 + i % 5) for i in range(300)]
    engagement = [("hot", "N1", 1.0, 2.5, 1.0, 2.0, 3.0)]
    engagement += [(f"k{i}", f"N{i % 4}", float(i), 1.0, 1.0, 1.0, 1.0) for i in range(0, 300, 2)]
    return installs, trials, ratings, engagement


def brute_force(installs, trials, ratings, engagement):
    out = set()
    for (k, u, c), (k2, u2, o), (k3, s), m in product(set(installs), set(trials), set(ratings),
                                                      set(engagement)):
        if k == k2 == k3 == m[0] and u == u2:
            out.add((k, u, c, o, s) + m[1:])
    return out


def test_merged_mart_with_hot_key_is_exact_and_split(spark):
    installs, trials, ratings, engagement = inputs()
    # brute force over the product is too slow; restrict it per key instead
    want = set()
    for key in {k for k, _, _ in installs}:
        want |= brute_force([r for r in installs if r[0] == key], [r for r in trials if r[0] == key],
                            [r for r in ratings if r[0] == key], [r for r in engagement if r[0] == key])
    with conf(spark, SKEW_CONF):
        df = marts.build_merged_app_users(
            spark.createDataFrame(installs, "hash_key string, user_id string, hash_date_campaign_country string"),
            spark.createDataFrame(trials, "hash_key string, user_id string, order_id string"),
            spark.createDataFrame(ratings, "hash_key string, star_rating long"),
            spark.createDataFrame(engagement, "hash_key string, country_code string, sessions double, "
                                              "avg_session_duration double, dau double, wau double, mau double"),
            ETL)
        rows = df.collect()          # runs df's own plan, so its final plan is readable
        plan = df._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r)[:-1] for r in rows]       # without etl_timestamp
    assert len(got) == len(set(got))            # no duplicates without a final DISTINCT
    assert set(got) == want
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_over_bound_semi_lookup_with_hot_key_is_exact_and_split(spark):
    from appmart.operators import semi_lookup
    fact_rows = [("hot", i) for i in range(6000)] + [(f"k{i % 500}", i) for i in range(12000)]
    dim_rows = [("hot",), ("hot",)] + [(f"k{i}",) for i in range(0, 500, 2)]
    with conf(spark, SKEW_CONF):
        fact = spark.createDataFrame(fact_rows, "hash_key string, v long")
        dim = spark.createDataFrame(dim_rows, "hash_key string")
        df = semi_lookup(fact, dim, "hash_key", max_broadcast_rows=0)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    keys = {k for (k,) in dim_rows}
    assert sorted(map(tuple, rows)) == sorted(r for r in fact_rows if r[0] in keys)
    assert "SortMergeJoin(skew=true)" in plan and "LeftSemi" in plan
