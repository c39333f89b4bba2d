"""Facts on literal rows (trial timestamps, T8) and the table store in catalog mode."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from appmart.plans import dims, facts
from appmart.schemas import RAW_SCHEMAS, STATISTICS_SCHEMA
from appmart.sources.tables import TableStore

ETL = "2024-02-01T06:30:00+00:00"


def trials(spark, install_ts):
    row = (install_ts, "2024-01-05 10:00:00.5 UTC", "pkg", "u1", "sku1", "o1", "tok", 1.0, "1.0", "Com.App")
    return spark.createDataFrame([row], RAW_SCHEMAS["user_subscription_trials"])


def test_trials_keyed_by_install_day_with_fractional_purchase(spark):
    raw = trials(spark, "2024-01-05 09:00:00 UTC")
    empty = {name: spark.createDataFrame([], RAW_SCHEMAS[name])
             for name in ("package_engagement_metrics", "app_ratings", "user_installs")}
    dim = dims.build_app_user_dim(empty["package_engagement_metrics"], empty["app_ratings"],
                                  empty["user_installs"], raw, ETL)
    out = facts.build_trials(raw, dim, ETL).select(
        "user_id", "order_id", F.col("install_timestamp").cast("timestamp_ntz").alias("i"),
        F.col("purchase_timestamp").cast("timestamp_ntz").alias("p")).collect()
    assert [tuple(r) for r in out] == [("u1", "o1", dt.datetime(2024, 1, 5, 9), dt.datetime(2024, 1, 5, 10, 0, 0, 500000))]


def test_fractional_install_seconds_fail_the_build(spark):
    # The key parses install time with whole seconds only; a fraction is an error.
    raw = trials(spark, "2024-01-05 09:00:00.25 UTC")
    dim = spark.createDataFrame([("x",)], "hash_key string")
    with pytest.raises(Exception):
        facts.build_trials(raw, dim, ETL).collect()


def test_table_store_catalog_mode(spark, scratch):
    db = "appmart_test_catalog"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(scratch, db)}'")
    store = TableStore(spark)
    assert store.location(db, "t") == f"{db}.t"
    store.ensure(db, "stats", STATISTICS_SCHEMA, keep=True)
    assert store.exists(db, "stats") and store.read(db, "stats").count() == 0
    store.write_full(spark.range(3), db, "t")
    store.write_full(spark.range(2), db, "t")
    assert store.read(db, "t").count() == 2
    store.append(spark.range(2), db, "t")
    assert store.read(db, "t").count() == 4
    # a kept table is not replaced
    store.append(spark.createDataFrame([("a", None, None, None, 0.1, 1, 1)], STATISTICS_SCHEMA), db, "stats")
    store.ensure(db, "stats", STATISTICS_SCHEMA, keep=True)
    assert store.read(db, "stats").count() == 1
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_table_store_parquet_mode(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "wh"))
    assert not store.exists("data", "t")
    store.ensure("data", "t", STATISTICS_SCHEMA)
    assert store.exists("data", "t") and store.read("data", "t").schema == STATISTICS_SCHEMA


def test_snapshot_shows_nothing_before_it_is_published(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "wh"))
    assert store.write_full(spark.range(3), "data", "a") == 3
    snapshot = store.snapshot()
    assert snapshot.write(spark.range(5), "data", "a") == 5 and snapshot.write(spark.range(0), "data", "b") == 0
    assert store.read("data", "a").count() == 3 and not store.exists("data", "b")
    assert snapshot.read("data", "a").count() == 5
    # A table written meanwhile keeps its own version.
    store.write_full(spark.range(7), "data", "c")
    snapshot.publish()
    reader = TableStore(spark, os.path.join(scratch, "wh"))
    assert [reader.read("data", t).count() for t in "abc"] == [5, 0, 7]


def test_a_reader_of_the_last_snapshot_still_finds_its_files(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "wh"))
    store.write_full(spark.range(3), "data", "a")
    old = store.read("data", "a")
    store.write_full(spark.range(5), "data", "a")
    assert old.count() == 3 and old.agg(F.sum("id")).first()[0] == 3
    store.write_full(spark.range(6), "data", "a")
    assert len([v for v in os.listdir(store.location("data", "a")) if v.startswith("v-")]) == 2


def test_append_adds_a_part_to_the_published_version(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "wh"))
    store.append(spark.range(2), "data", "a")
    store.append(spark.range(3), "data", "a")
    store.write_full(spark.range(1), "data", "b")
    assert store.read("data", "a").count() == 5
    failing = spark.range(9).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception):
        store.append(failing, "data", "a")
    assert store.read("data", "a").count() == 5
    assert store.write_full(spark.range(4), "data", "a") == 4 and store.read("data", "a").count() == 4


def test_two_jobs_cannot_publish_the_same_manifest(spark, scratch, monkeypatch):
    store = TableStore(spark, os.path.join(scratch, "wh"))
    store.write_full(spark.range(3), "data", "a")
    other = TableStore(spark, os.path.join(scratch, "wh"))
    listed = other._manifests()
    monkeypatch.setattr(other, "_manifests", lambda: listed)
    store.write_full(spark.range(4), "data", "a")
    with pytest.raises(RuntimeError, match="another job"):
        other.write_full(spark.range(5), "data", "a")
    assert store.read("data", "a").count() == 4


def test_a_plain_catalog_table_becomes_a_view(spark, scratch):
    db = "appmart_test_views"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(scratch, db)}'")
    try:
        spark.range(2).write.saveAsTable(f"{db}.t")
        store = TableStore(spark)
        for n in (3, 4, 5):
            assert store.write_full(spark.range(n), db, "t") == n and store.read(db, "t").count() == n
        versions = spark.sql(f"SHOW TABLES IN {db} LIKE 't__v_*'").collect()
        assert len(versions) == 2
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
