"""Full-refresh pipeline over fixture CSVs: order, invariants, statistics, rerun."""

from __future__ import annotations

import os
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from appmart import catalog
from appmart import operators as ops
from appmart.plans import dims, facts, marts, pipeline
from appmart.plans.pipeline import MART_DB, RAW_DB, run_pipeline
from appmart.schemas import (KEY_CHECKS_TABLE, MART_SCHEMAS, MART_STATISTICS_TABLE, RAW_SCHEMAS,
                             RAW_STATISTICS_TABLE)
from appmart.sources.csv import write_csv
from appmart.sources.tables import TableStore, qualify

from conftest import SF_SMALL

ETL = catalog.ETL_TS  # same run timestamp as the lazy builds


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pipeline"))
    src = os.path.join(root, "sources")
    for name, build in catalog.fx.RAW_BUILDERS.items():
        write_csv(build(spark, SF_SMALL), f"{src}/{name}.csv")
    store = TableStore(spark, os.path.join(root, "warehouse"))
    counts = run_pipeline(spark, src, store, etl_ts=ETL, dag_execution_date=ETL)
    return store, counts, src


def test_every_table_is_written(run):
    store, counts, _ = run
    for name in RAW_SCHEMAS:
        assert f"{RAW_DB}.{name}" in counts
    for name in MART_SCHEMAS:
        assert f"{MART_DB}.{name}" in counts


def test_raw_tables_are_stamped_with_the_run_timestamp(run):
    store, _, _ = run
    for name in RAW_SCHEMAS:
        stamps = store.read(RAW_DB, name).select(F.col("etl_timestamp").cast("string")).distinct().collect()
        assert [r[0] for r in stamps] == ["2024-02-01 06:30:00.25"]


def test_modelled_tables_have_declared_schemas(run):
    store, _, _ = run
    for name, schema in MART_SCHEMAS.items():
        got = store.read(MART_DB, name).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema]


def test_facts_keys_exist_in_dimensions(run):
    store, _, _ = run
    app = store.read(MART_DB, dims.APP_USER_DIM)
    camp = store.read(MART_DB, dims.CAMPAIGN_DIM)
    for fact in (facts.ENGAGEMENT, facts.RATING, facts.INSTALLS, facts.TRIALS, marts.MERGED):
        assert ops.fk_orphans(store.read(MART_DB, fact), app, "hash_key").count() == 0
    for fact, fk in ((facts.INSTALLS, "hash_date_campaign_country"), (facts.SPEND, "hash_key"),
                     (marts.MERGED, "hash_date_campaign_country")):
        assert ops.fk_orphans(store.read(MART_DB, fact), camp, fk).count() == 0


def test_statistics_rows_and_distinct_rows(run):
    store, counts, _ = run
    stats = {r["table_name"]: r for r in store.read(MART_DB, MART_STATISTICS_TABLE).collect()}
    assert set(stats) == set(MART_SCHEMAS)
    for name, r in stats.items():
        assert r["row_loaded_to_bq"] == counts[f"{MART_DB}.{name}"]
        # every modelled table is a DISTINCT, so no duplicate rows
        assert r["distinct_row_loaded_to_bq"] == r["row_loaded_to_bq"]
        assert r["duration_loading_to_bq_min"] >= 0
    raw = {r["table_name"] for r in store.read(RAW_DB, RAW_STATISTICS_TABLE).collect()}
    assert raw == set(RAW_SCHEMAS)


def test_dimension_keys_are_not_unique(run):
    # Raw spellings are kept next to the normalised key (defined behaviour).
    store, _, _ = run
    assert ops.pk_duplicates(store.read(MART_DB, dims.APP_USER_DIM), "hash_key").count() > 0


def test_pipeline_tables_equal_lazy_builds(spark, run):
    store, _, _ = run
    i = catalog.Inputs(spark, SF_SMALL)
    lazy = {dims.APP_USER_DIM: i.app_dim, dims.CAMPAIGN_DIM: i.campaign_dim, facts.ENGAGEMENT: i.engagement,
            facts.INSTALLS: i.installs, facts.TRIALS: i.trials, facts.SPEND: i.spend, facts.RATING: i.ratings}
    for name, df in lazy.items():
        stored = store.read(MART_DB, name)
        assert stored.exceptAll(df).count() == 0 and df.exceptAll(stored).count() == 0, name


def test_rerun_replaces_tables_and_keeps_statistics_by_run(spark, run):
    store, counts, src = run
    before = {name: Counter(map(tuple, store.read(MART_DB, name).collect())) for name in MART_SCHEMAS}
    # the first run had independent steps side by side; this one runs them in turn
    again = run_pipeline(spark, src, store, etl_ts=ETL, dag_execution_date=ETL, workers=1)
    assert again == counts
    for name in MART_SCHEMAS:
        assert Counter(map(tuple, store.read(MART_DB, name).collect())) == before[name], name

    def per_table(db, table):
        return {r["count"] for r in store.read(db, table).groupBy("table_name").count().collect()}
    # a repeated run replaces its rows, another date adds its own
    assert per_table(MART_DB, MART_STATISTICS_TABLE) == per_table(RAW_DB, RAW_STATISTICS_TABLE) == {1}
    assert store.read(MART_DB, KEY_CHECKS_TABLE).count() == 10
    run_pipeline(spark, src, store, etl_ts=ETL, dag_execution_date="2024-02-02T06:00:00+00:00")
    assert per_table(MART_DB, MART_STATISTICS_TABLE) == per_table(RAW_DB, RAW_STATISTICS_TABLE) == {2}
    assert store.read(MART_DB, KEY_CHECKS_TABLE).count() == 20


def test_key_checks_are_recorded(run):
    store, _, _ = run
    found = {(r["table_name"], r["column_name"]): r for r in store.read(MART_DB, KEY_CHECKS_TABLE).collect()}
    for (table, column), r in found.items():
        if r["constraint_type"] == "PRIMARY KEY":
            assert r["violations"] == ops.pk_duplicates(store.read(MART_DB, table), column).count()
        else:
            assert r["violations"] == 0 and r["reference_table"]
    assert found[dims.APP_USER_DIM, "hash_key"]["violations"] > 0


class Died(Exception):
    pass


def _dies_at(monkeypatch, table):
    """The pipeline's job dies when it comes to write ``table``."""
    real = TableStore.write_version

    def write(self, df, db, name):
        if name == table:
            raise Died(name)
        return real(self, df, db, name)
    monkeypatch.setattr(TableStore, "write_version", write)


def _all_tables(store, db_raw=RAW_DB, db_mart=MART_DB):
    names = [(db_raw, n) for n in [*RAW_SCHEMAS, RAW_STATISTICS_TABLE]]
    names += [(db_mart, n) for n in [*MART_SCHEMAS, MART_STATISTICS_TABLE, KEY_CHECKS_TABLE]]
    return {(db, n): Counter(map(tuple, store.read(db, n).collect())) for db, n in names}


@pytest.mark.parametrize("table", [marts.COUNTRY_AVERAGES, MART_STATISTICS_TABLE])
def test_a_run_that_dies_between_two_marts_leaves_the_old_run_whole(spark, run, tmp_path, monkeypatch, table):
    _, _, src = run
    store = TableStore(spark, str(tmp_path / "wh"))
    run_pipeline(spark, src, store, etl_ts=ETL, dag_execution_date=ETL, workers=1)
    before = _all_tables(store)
    later = "2024-03-01T00:00:00+00:00"
    with monkeypatch.context() as m:
        _dies_at(m, table)
        with pytest.raises(Died):
            run_pipeline(spark, src, store, etl_ts=later, dag_execution_date=later, workers=1)
    # Another reader sees the old run in all tables, though eight raw tables and most marts were written anew.
    assert _all_tables(TableStore(spark, str(tmp_path / "wh"))) == before
    run_pipeline(spark, src, store, etl_ts=later, dag_execution_date=later, workers=1)
    stamps = {r[0] for db, n in [(RAW_DB, n) for n in RAW_SCHEMAS] + [(MART_DB, n) for n in MART_SCHEMAS]
              for r in store.read(db, n).select(F.col("etl_timestamp").cast("string")).distinct().collect()}
    assert stamps == {"2024-03-01 00:00:00"}
    # The versions of the dead run are gone: two snapshots' ones are left.
    kept = {v for n in store._manifests() for v in store._load(n)[f"{MART_DB}.{marts.MERGED}"]}
    assert set(os.listdir(store.location(MART_DB, marts.MERGED))) == kept and len(kept) == 2


def test_a_dead_run_leaves_the_views_of_the_catalog(spark, run, tmp_path, monkeypatch):
    _, _, src = run
    for db in ("dead_raw", "dead_mart"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path / db}'")
    try:
        store = TableStore(spark)
        args = {"workers": 4, "db_raw": "dead_raw", "db_mart": "dead_mart"}
        run_pipeline(spark, src, store, etl_ts=ETL, dag_execution_date=ETL, **args)
        before = _all_tables(store, "dead_raw", "dead_mart")
        with monkeypatch.context() as m:
            _dies_at(m, marts.MERGED)
            with pytest.raises(Died):
                run_pipeline(spark, src, store, etl_ts="2024-03-01T00:00:00+00:00", **args)
        assert _all_tables(TableStore(spark), "dead_raw", "dead_mart") == before
    finally:
        for db in ("dead_raw", "dead_mart"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_the_callers_settings_come_back(spark, run, tmp_path, monkeypatch):
    from appmart.plans import pipeline
    _, _, src = run
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    inside = []
    monkeypatch.setattr("appmart.session.SOURCE_BYTES_PER_SHUFFLE_PARTITION", 1000)
    monkeypatch.setattr(pipeline, "_load_and_build", lambda *a: inside.append(spark.conf.get(keys[0])))
    run_pipeline(spark, src, TableStore(spark, str(tmp_path / "wh")), etl_ts=ETL)
    assert int(inside[0]) > int(before[0]) and [spark.conf.get(k) for k in keys] == before


def test_a_run_leaves_no_scratch_folder(spark, run, tmp_path):
    from appmart.session import materialise, run_dir, scratch_folders, shared_dir, side_by_side
    base = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    run_pipeline(spark, run[2], TableStore(spark, str(tmp_path / "wh")), etl_ts=ETL)
    assert set(os.listdir(base)) == before
    with scratch_folders(spark):
        stored = side_by_side(spark, {n: (lambda n=n: materialise(spark.range(n), "x")) for n in (3, 4)})
        assert [stored[n].count() for n in (3, 4)] == [3, 4]
        inside = set(os.listdir(base)) - before
        assert len(inside) == 1 and len(os.listdir(os.path.join(base, *inside))) == 2
    assert set(os.listdir(base)) == before and "/scratch-" not in run_dir(spark, "y")


def test_qualify_names():
    assert qualify("analytics.t", "data") == ("analytics", "t")
    assert qualify("t", "data") == ("data", "t")
    with pytest.raises(ValueError):
        qualify("a.b.c", "data")


def test_custom_namespaces(spark, run, tmp_path):
    _, counts, src = run
    store = TableStore(spark, str(tmp_path / "wh"))
    got = run_pipeline(spark, src, store, etl_ts=ETL, dag_execution_date=ETL,
                       db_raw="landing", db_mart="mart")
    assert got == {k.replace(f"{RAW_DB}.", "landing.").replace(f"{MART_DB}.", "mart."): v
                   for k, v in counts.items()}
    assert store.exists("mart", marts.MERGED) and store.exists("landing", RAW_STATISTICS_TABLE)


def test_catalog_mode_run_matches(spark, run, tmp_path):
    # Session-catalog tables (the command line's default), steps side by side.
    _, counts, src = run
    for db in ("cat_raw", "cat_mart"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path / db}'")
    try:
        got = run_pipeline(spark, src, TableStore(spark), etl_ts=ETL, dag_execution_date=ETL,
                           workers=4, db_raw="cat_raw", db_mart="cat_mart")
        assert got == {k.replace(f"{RAW_DB}.", "cat_raw.").replace(f"{MART_DB}.", "cat_mart."): v
                       for k, v in counts.items()}
        assert spark.table(f"cat_mart.{marts.MERGED}").count() == counts[f"{MART_DB}.{marts.MERGED}"]
    finally:
        for db in ("cat_raw", "cat_mart"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_bad_sources_leave_the_last_run_readable(spark, run, tmp_path):
    store, counts, src = run
    before = {name: store.read(RAW_DB, name).count() for name in RAW_SCHEMAS}
    with pytest.raises(ValueError, match="missing"):
        run_pipeline(spark, str(tmp_path), store, etl_ts=ETL)
    stranger = os.path.join(src, "extra.csv")
    with open(stranger, "w") as f:
        f.write("a\n1\n")
    try:
        with pytest.raises(ValueError, match="extra.csv"):
            run_pipeline(spark, src, store, etl_ts=ETL)
    finally:
        os.remove(stranger)
    assert {name: store.read(RAW_DB, name).count() for name in RAW_SCHEMAS} == before


def test_a_write_that_fails_midway_leaves_the_old_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write_full(spark.range(5), "data", "t")
    failing = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        store.write_full(failing, "data", "t")
    assert store.read("data", "t").count() == 5
    for n in (6, 7, 8):
        store.write_full(spark.range(n), "data", "t")
    assert store.read("data", "t").count() == 8


def test_submit_script_shows_its_options():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run([sys.executable, os.path.join(root, "submit_pipeline.py"), "--help"],
                          capture_output=True, text=True, cwd="/", timeout=120)
    assert said.returncode == 0 and "--src" in said.stdout


def test_sources_of_the_pipeline_queries_are_written_side_by_side(spark, monkeypatch):
    two = threading.Barrier(2)
    monkeypatch.setattr(catalog, "write_csv", lambda df, path: two.wait(60))
    monkeypatch.setattr(catalog, "run_pipeline", lambda *args, **more: None)
    catalog._pipeline_run(catalog.Inputs(spark, SF_SMALL), ETL)


def test_statistics_and_key_checks_are_written_side_by_side(spark, monkeypatch, tmp_path):
    three, kept = threading.Barrier(3), []
    monkeypatch.setattr(pipeline.checks, "key_checks", lambda *args: None)
    monkeypatch.setattr(pipeline.Run, "keep", lambda self, rows, db, table: (three.wait(60), kept.append(table)))
    run = pipeline.Run(spark, TableStore(spark, str(tmp_path)), ETL, ETL)
    run.statistics = {(RAW_DB, RAW_STATISTICS_TABLE): [], (MART_DB, MART_STATISTICS_TABLE): []}
    run.publish(MART_DB, {})
    assert sorted(kept) == sorted([RAW_STATISTICS_TABLE, MART_STATISTICS_TABLE, KEY_CHECKS_TABLE])
