"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from appmart import catalog
from appmart.plans import dims, facts, marts
from appmart.plans import keyed as ky
from appmart.schemas import RAW_SCHEMAS
from appmart.sources import fixtures as fx

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fixture_scan_pushes_event_filter_and_prunes_columns(spark):
    df = fx.spend_raw(spark, SF_SMALL)
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "props" not in read_schema and "event_id" in read_schema


def test_merged_app_users_has_no_product_join(spark):
    i = catalog.Inputs(spark, SF_SMALL)
    df = marts.build_merged_app_users(i.installs, i.trials, i.ratings, i.engagement, catalog.ETL_TS)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert plan.count("Join") >= 3


def test_naive_coalesce_join_would_be_a_product(spark):
    # The rewrite exists because this form plans as a Cartesian product when
    # the right key is nullable, as every column read back from Parquet is.
    i = catalog.Inputs(spark, SF_SMALL, stored_facts=(facts.INSTALLS, facts.ENGAGEMENT))
    left = i.installs.select(F.col("hash_key").alias("lk"))
    right = i.engagement.select(F.col("hash_key").alias("rk"))
    spark.conf.set("spark.sql.crossJoin.enabled", "true")
    naive = left.join(right, F.col("lk") == F.coalesce(F.col("rk"), F.col("lk")))
    assert "CartesianProduct" in plan_of(naive) or "NestedLoopJoin" in plan_of(naive)


def test_country_lookup_is_broadcast_after_size_check(spark):
    df = catalog.registry()["avg_session_by_country"](spark, SF_SMALL)
    plan = plan_of(df)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_facts_read_materialised_dimensions(spark):
    # Dims and facts are written once per query context and read back as Parquet.
    i = catalog.Inputs(spark, SF_SMALL)
    plan = plan_of(i.app_dim)
    assert "FileScan parquet" in plan and "events" not in plan


def test_no_plan_time_broadcast_from_estimates(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shared_folder_is_registered_for_local_runs(spark):
    from appmart.session import run_dir, shared_dir
    base = shared_dir(spark)
    assert base and run_dir(spark, "x").startswith(base.rstrip("/") + "/x-")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_over_bound_semi_join_and_distinct_share_one_shuffle(spark):
    # A dimension too large to broadcast: the fact is shuffled by hash_key for
    # the semi-join, and the DISTINCT reuses that partitioning.
    from appmart.operators import semi_lookup
    i = catalog.Inputs(spark, SF_SMALL)
    keyed = facts.spend_keyed(i.spend_raw)          # no shuffle of its own
    out = semi_lookup(keyed, i.campaign_dim, "hash_key", max_broadcast_rows=0).distinct()
    out.write.format("noop").mode("overwrite").save()
    plan = plan_of(out)
    assert "SortMergeJoin" in plan and "LeftSemi" in plan
    assert plan.count("Exchange hashpartitioning") == 2     # one per join side, none for DISTINCT


def _ran(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return plan_of(df)


@pytest.mark.parametrize("source", ky.SOURCES)
def test_staged_source_is_scanned_and_hashed_once_and_its_fact_needs_no_exchange(spark, source):
    i = catalog.Inputs(spark, SF_SMALL, staged=[source])
    staged = i.keyed(source)
    assert i.keyed(source) is staged
    rows = ky.fact_rows(source, staged)
    plan = _ran(rows)
    assert "md5" not in plan and "events" not in plan and "Exchange" not in plan
    assert plan.count("FileScan parquet") == 1 and "Bucketed: true" in plan
    # The raw form of the same fact parses and shuffles; the rows are the same.
    raw = ky.fact_rows(source, i.raw(source))
    assert "Exchange" in plan_of(raw) and "events" in plan_of(raw)
    assert rows.exceptAll(raw).count() == 0 and raw.exceptAll(rows).count() == 0


def test_dimension_and_fact_read_the_staged_source_without_keys_of_their_own(spark):
    i = catalog.Inputs(spark, SF_SMALL, staged=ky.SOURCES)
    i.prefetch([dims.APP_USER_DIM, dims.CAMPAIGN_DIM])
    for name in (dims.APP_USER_DIM, dims.CAMPAIGN_DIM, facts.INSTALLS, facts.TRIALS, facts.SPEND):
        plan = plan_of(i.lazy(name))
        assert "md5" not in plan and "PushedFilters: [IsNotNull(event_type)" not in plan, name


def test_hot_key_spreads_over_the_buckets_of_a_staged_source(spark):
    rows = [("N1", float(n)) for n in range(2000)]
    raw = spark.createDataFrame([("app", "2024-01-05", c, "1.0", x, 1.0, 1.0, 1.0, 1.0) for c, x in rows],
                                RAW_SCHEMAS[ky.ENGAGEMENT])
    staged = ky.stage(ky.ENGAGEMENT, raw)
    assert staged.select("hash_key").distinct().count() == 1
    shares = [r["count"] for r in staged.groupBy(F.input_file_name().alias("f")).count().collect()]
    assert len(shares) == 8 and max(shares) < 2 * 2000 / 8


def test_over_bound_fact_exchanges_distinct_rows_only(spark, monkeypatch):
    # A dimension too large to broadcast: duplicates go in the buckets, then the rest is shuffled by key.
    from appmart.operators import joins
    monkeypatch.setattr(joins, "fits", lambda *a, **k: False)
    i = catalog.Inputs(spark, SF_SMALL, staged=[ky.SPEND])
    out = facts.build_spend(i.keyed(ky.SPEND), i.campaign_dim, catalog.ETL_TS)
    plan = _ran(out).split("== Initial Plan ==")[0]
    assert "LeftSemi" in plan and plan.count("Exchange hashpartitioning(hash_key") == 2
    below = plan.split("Exchange hashpartitioning(hash_key")[1]
    assert "HashAggregate" in below and "Bucketed: true" in plan


def test_side_by_side_steps_keep_the_callers_job_group(spark):
    from appmart.session import side_by_side
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    sc.setJobGroup("side-by-side", "steps")
    try:
        out = side_by_side(spark, {str(n): (lambda n=n: spark.range(n).count()) for n in (3, 4, 5)})
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert out == {"3": 3, "4": 4, "5": 5}
    assert len(tracker.getJobIdsForGroup("side-by-side")) >= 3


def test_side_by_side_steps_do_not_share_local_properties(spark):
    # Each step sets a property of its own; with a shared snapshot they would clash.
    from appmart.session import side_by_side
    sc = spark.sparkContext

    def step(n):
        sc.setLocalProperty("appmart.test.step", str(n))
        spark.range(n * 1000).selectExpr("sum(id)").collect()
        return sc.getLocalProperty("appmart.test.step")

    out = side_by_side(spark, {str(n): (lambda n=n: step(n)) for n in range(1, 9)}, workers=8)
    assert out == {str(n): str(n) for n in range(1, 9)}
