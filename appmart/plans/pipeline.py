"""Full-refresh pipeline (G15): sources → raw → keyed → dimensions → facts → marts.

Every table is written once (stamped and counted in the same write) as a version
that nobody sees yet. Steps run in true dependency order and read the versions
of this run: the keyed copies of the raw sources (scanned and hashed once each),
the written dimensions, the written facts. Each step reads stored tables, so a
lost executor only recomputes the current step.

The last step publishes all tables, their statistics and the key checks together
(see ``sources.tables``). A run that dies before leaves the last run's tables as
they are, all of them. Statistics rows and key checks are kept by run: a run that is
repeated for the same scheduler date replaces its rows.

Steps of one stage (the raw loads; the keyed copies; the two dimensions; the five
facts; the two marts; statistics and key checks) are independent and are submitted from a few driver threads,
so Spark schedules their jobs side by side and small tables do not leave the
cluster idle.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appmart import functions as fn
from appmart.functions import new_etl_ts
from appmart.operators import stamp
from appmart.plans import checks, dims, facts, marts
from appmart.plans import keyed as ky
from appmart.plans.stats import load_statistics
from appmart.schemas import (KEY_CHECKS_SCHEMA, KEY_CHECKS_TABLE, MART_STATISTICS_TABLE, RAW_SCHEMAS,
                             RAW_STATISTICS_TABLE, STATISTICS_SCHEMA, raw_schema, stamped)
from appmart.session import R, fit_shuffle_partitions, fit_split_size, kept_settings, scratch_folders, side_by_side
from appmart.sources.csv import discover_sources, read_csv
from appmart.sources.tables import TableStore

RAW_DB = "data"
MART_DB = "analytics"


class Run:
    """One pipeline run: a store, the run timestamp and the scheduler's run date."""

    def __init__(self, spark: SparkSession, store: TableStore, etl_ts: str,
                 dag_execution_date: str | None, workers: int = 4):
        self.spark, self.store, self.snapshot = spark, store, store.snapshot()
        self.etl_ts, self.dag_execution_date = etl_ts, dag_execution_date
        self.workers = max(1, workers)
        self.row_counts: dict[str, int] = {}
        self.statistics: dict[tuple[str, str], list[DataFrame]] = {}

    def materialise(self, db: str, table: str, stats_table: str,
                    build: Callable[[], DataFrame]) -> DataFrame:
        """Write ``build()`` as ``db.table`` and take its statistics; returns the stored table."""
        started = time.time()
        written = self.snapshot.write(build(), db, table)
        stored = self.snapshot.read(db, table)
        stats, counted = load_statistics(self.spark, stored, table, started, self.etl_ts,
                                         self.dag_execution_date)
        if counted != written:
            raise RuntimeError(f"{db}.{table}: {written} rows were written, {counted} are there")
        self.statistics.setdefault((db, stats_table), []).append(stats)
        self.row_counts[f"{db}.{table}"] = written
        return stored

    def keep(self, rows: list[DataFrame], db: str, table: str) -> None:
        """``rows`` of this run beside those of other runs; those of an earlier try of this run go."""
        date = fn.ts_literal(self.dag_execution_date)
        new = rows[0]
        for more in rows[1:]:
            new = new.unionByName(more)
        if self.store.exists(db, table):
            others = self.store.read(db, table).where(~F.col("dag_execution_date").eqNullSafe(date))
            new = others.unionByName(new)
        self.snapshot.write(new.coalesce(1), db, table)

    def publish(self, db_mart: str, mart: Mapping[str, DataFrame]) -> None:
        """Statistics and key checks, then one switch of everything."""
        steps = {f"{db}.{table}": (lambda n=(db, table), r=rows: self.keep(r, *n))
                 for (db, table), rows in self.statistics.items()}
        self.stage({**steps, KEY_CHECKS_TABLE: lambda: self.keep(
            [checks.key_checks(mart, self.etl_ts, self.dag_execution_date)], db_mart, KEY_CHECKS_TABLE)})
        self.snapshot.publish()

    def stage(self, steps: Mapping[str, Callable[[], R]]) -> dict[str, R]:
        """Run independent steps side by side; returns their stored tables."""
        return side_by_side(self.spark, steps, self.workers)


def run_pipeline(spark: SparkSession, src_dir: str, store: TableStore, etl_ts: str | None = None,
                 dag_execution_date: str | None = None, workers: int = 4,
                 db_raw: str = RAW_DB, db_mart: str = MART_DB,
                 optional: Collection[str] = ()) -> dict[str, int]:
    """Load every CSV in ``src_dir`` and rebuild all modelled tables; returns row counts.

    Raw tables go to namespace ``db_raw``, modelled ones to ``db_mart``.
    ``workers`` bounds how many independent steps of a stage run at once
    (1 runs every step in turn). ``optional`` names raw tables that may have no
    source; they are then empty. Any other gap or stranger in ``src_dir`` is an error.
    """
    etl_ts = etl_ts or new_etl_ts()
    run = Run(spark, store, etl_ts, dag_execution_date or etl_ts, workers)

    # Every source is found and named before anything is written, so a bad
    # folder leaves the tables of the last run as they are.
    sources = discover_sources(spark, src_dir, RAW_SCHEMAS, optional)

    # Size the shuffle width and the input splits from the input once; the
    # caller's settings come back at the end.
    source_bytes = sum(size for _, size in sources.values())
    with (kept_settings(spark, "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"),
          scratch_folders(spark)):
        fit_shuffle_partitions(spark, source_bytes)
        fit_split_size(spark, source_bytes)
        try:
            _load_and_build(run, sources, db_raw, db_mart)
        except BaseException:
            run.snapshot.abandon()
            raise
    return run.row_counts


def _load_and_build(run: Run, sources: Mapping[str, tuple[str, int]], db_raw: str, db_mart: str) -> None:
    spark, etl_ts = run.spark, run.etl_ts
    for name in set(RAW_SCHEMAS) - set(sources):
        run.snapshot.write(spark.createDataFrame([], stamped(RAW_SCHEMAS[name])), db_raw, name)

    # Positional fixed-schema scan, stamped in the same full-width write.
    def load(table: str, path: str) -> Callable[[], DataFrame]:
        schema = raw_schema(table)
        return lambda: run.materialise(db_raw, table, RAW_STATISTICS_TABLE,
                                       lambda: stamp(read_csv(spark, path, schema), etl_ts))

    run.stage({table: load(table, path) for table, (path, _) in sources.items()})
    raw = {name: run.snapshot.read(db_raw, name) for name in RAW_SCHEMAS}
    keyed = run.stage({name: (lambda n=name: ky.stage(n, raw[n])) for name in ky.SOURCES})

    def mart(table: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        return lambda: run.materialise(db_mart, table, MART_STATISTICS_TABLE, build)

    dim = run.stage({
        dims.APP_USER_DIM: mart(dims.APP_USER_DIM, lambda: dims.build_app_user_dim(
            keyed[ky.ENGAGEMENT], keyed[ky.RATINGS], keyed[ky.INSTALLS], keyed[ky.TRIALS], etl_ts)),
        dims.CAMPAIGN_DIM: mart(dims.CAMPAIGN_DIM, lambda: dims.build_campaign_dim(
            keyed[ky.INSTALLS], keyed[ky.SPEND], etl_ts)),
    })
    app_dim, camp_dim = dim[dims.APP_USER_DIM], dim[dims.CAMPAIGN_DIM]

    fact = run.stage({
        facts.INSTALLS: mart(facts.INSTALLS, lambda: facts.build_installs(
            keyed[ky.INSTALLS], app_dim, camp_dim, etl_ts)),
        facts.TRIALS: mart(facts.TRIALS, lambda: facts.build_trials(keyed[ky.TRIALS], app_dim, etl_ts)),
        facts.RATING: mart(facts.RATING, lambda: facts.build_ratings(keyed[ky.RATINGS], app_dim, etl_ts)),
        facts.ENGAGEMENT: mart(facts.ENGAGEMENT, lambda: facts.build_engagement(
            keyed[ky.ENGAGEMENT], app_dim, etl_ts)),
        facts.SPEND: mart(facts.SPEND, lambda: facts.build_spend(keyed[ky.SPEND], camp_dim, etl_ts)),
    })

    last = run.stage({
        marts.MERGED: mart(marts.MERGED, lambda: marts.build_merged_app_users(
            fact[facts.INSTALLS], fact[facts.TRIALS], fact[facts.RATING],
            fact[facts.ENGAGEMENT], etl_ts)),
        marts.COUNTRY_AVERAGES: mart(marts.COUNTRY_AVERAGES, lambda: marts.build_country_averages(
            fact[facts.ENGAGEMENT], raw["country_code_to_name"], etl_ts)),
    })
    run.publish(db_mart, {**dim, **fact, **last})
