"""Registered queries: one per operator, each over the whole test tables.

Every entry takes ``(spark, sf_dir)``, derives the raw app tables from the
shared test tables (``appmart.sources.fixtures``) and returns the operator's
output lazily. Timestamps leave as UTC wall-clock ``timestamp_ntz`` so a
comparison does not depend on the reader's time zone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appmart import functions as fn
from appmart import operators as ops
from appmart.functions.keys import app_user_key, campaign_key, day_text_from_date, day_text_from_ts
from appmart.plans import dims, facts, marts
from appmart.plans import keyed as ky
from appmart.plans.pipeline import MART_DB, RAW_DB, run_pipeline
from appmart.plans.stats import statistics_frame
from appmart.session import configure, materialise, run_dir, side_by_side
from appmart.sources import fixtures as fx
from appmart.sources.csv import read_csv, write_csv
from appmart.sources.tables import TableStore
from appmart.schemas import (KEY_CHECKS_TABLE, MART_SCHEMAS, MART_STATISTICS_TABLE, RAW_SCHEMAS,
                             RAW_STATISTICS_TABLE)

# Fixed run timestamp of the registered queries, so results are reproducible.
ETL_TS = "2024-02-01T06:30:00.250000+00:00"
DAG_EXECUTION_DATE = "2024-02-01T06:00:00+00:00"


def utc_wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock ``timestamp_ntz`` (session time zone is UTC)."""
    return df.select(*[
        F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields])


class Inputs:
    """Raw tables, dimensions and facts of one sf folder, built once per query.

    A table another step reads more than once is written as Parquet to the
    shared folder and read back (lineage cut, column pruning on re-read):
    the dimensions always (several facts conform to each), a fact only when
    the query names it in ``stored_facts`` (it reads that fact several
    times), a raw source with its keys when the query names it in ``staged``
    (a dimension and a fact read it). A query's own output stays a lazy plan:
    ``lazy(name)``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored_facts: Sequence[str] = (),
                 staged: Sequence[str] = ()):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self.stored_facts, self.staged = frozenset(stored_facts), frozenset(staged)
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build: Callable[[], DataFrame], keep: bool = False) -> DataFrame:
        if name not in self._cache:
            df = build()
            self._cache[name] = materialise(df, name) if keep else df
        return self._cache[name]

    def raw(self, name: str) -> DataFrame:
        return self._get("raw." + name, lambda: fx.RAW_BUILDERS[name](self.spark, self.sf_dir))

    def keyed(self, name: str) -> DataFrame:
        """A raw source with its keys: staged if the query says so, else its lazy projection."""
        if name in self.staged:
            if "keyed." + name not in self._cache:
                self._cache["keyed." + name] = ky.stage(name, self.raw(name))
            return self._cache["keyed." + name]
        return ky.keyed(name, self.raw(name))

    @property
    def engagement_raw(self): return self.raw("package_engagement_metrics")
    @property
    def ratings_raw(self): return self.raw("app_ratings")
    @property
    def installs_raw(self): return self.raw("user_installs")
    @property
    def trials_raw(self): return self.raw("user_subscription_trials")
    @property
    def spend_raw(self): return self.raw("ua_campaign_spendings")
    @property
    def countries(self): return self.raw("country_code_to_name")

    def lazy(self, name: str) -> DataFrame:
        """The plan of one modelled table, not stored."""
        return _BUILDS[name](self)

    def table(self, name: str) -> DataFrame:
        """A modelled table as an input: stored if it is a dimension or a fact in
        ``stored_facts``, else its lazy plan; built once either way."""
        keep = name in _DIMENSIONS or name in self.stored_facts
        return self._get(name, lambda: self.lazy(name), keep=keep)

    def prefetch(self, *stages: Sequence[str]) -> None:
        """Build the given inputs ahead, each stage's tables side by side.

        Tables of one stage must not depend on each other (dimensions, then
        facts), so no two threads build the same table.
        """
        if self.staged:
            side_by_side(self.spark, {name: (lambda n=name: self.keyed(n)) for name in sorted(self.staged)})
        for names in stages:
            side_by_side(self.spark, {name: (lambda n=name: self.table(n)) for name in names})

    @property
    def app_dim(self): return self.table(dims.APP_USER_DIM)
    @property
    def campaign_dim(self): return self.table(dims.CAMPAIGN_DIM)
    @property
    def engagement(self): return self.table(facts.ENGAGEMENT)
    @property
    def ratings(self): return self.table(facts.RATING)
    @property
    def installs(self): return self.table(facts.INSTALLS)
    @property
    def trials(self): return self.table(facts.TRIALS)
    @property
    def spend(self): return self.table(facts.SPEND)


_DIMENSIONS = (dims.APP_USER_DIM, dims.CAMPAIGN_DIM)
# Facts the merged mart reads; the statistics query reads them a second time.
_MART_INPUTS = (facts.ENGAGEMENT, facts.RATING, facts.INSTALLS, facts.TRIALS)


_BUILDS: dict[str, Callable[[Inputs], DataFrame]] = {
    dims.APP_USER_DIM: lambda i: dims.build_app_user_dim(
        i.keyed(ky.ENGAGEMENT), i.keyed(ky.RATINGS), i.keyed(ky.INSTALLS), i.keyed(ky.TRIALS), ETL_TS),
    dims.CAMPAIGN_DIM: lambda i: dims.build_campaign_dim(i.keyed(ky.INSTALLS), i.keyed(ky.SPEND), ETL_TS),
    facts.ENGAGEMENT: lambda i: facts.build_engagement(i.keyed(ky.ENGAGEMENT), i.app_dim, ETL_TS),
    facts.RATING: lambda i: facts.build_ratings(i.keyed(ky.RATINGS), i.app_dim, ETL_TS),
    facts.INSTALLS: lambda i: facts.build_installs(i.keyed(ky.INSTALLS), i.app_dim, i.campaign_dim, ETL_TS),
    facts.TRIALS: lambda i: facts.build_trials(i.keyed(ky.TRIALS), i.app_dim, ETL_TS),
    facts.SPEND: lambda i: facts.build_spend(i.keyed(ky.SPEND), i.campaign_dim, ETL_TS),
    marts.MERGED: lambda i: marts.build_merged_app_users(i.installs, i.trials, i.ratings,
                                                         i.engagement, ETL_TS),
    marts.COUNTRY_AVERAGES: lambda i: marts.build_country_averages(i.engagement, i.countries, ETL_TS),
}


QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str, stored_facts: Sequence[str] = (), staged: Sequence[str] = ()):
    def register(fn_: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        _REGISTRY[name] = lambda spark, sf_dir: utc_wall_clock(
            fn_(Inputs(spark, sf_dir, stored_facts=stored_facts, staged=staged)))
        return fn_
    return register


def registry() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


# --- A: sources, sinks, stamping ---------------------------------------------

@query("csv_roundtrip")
def q_csv_roundtrip(i: Inputs) -> DataFrame:
    """Installs written as CSV to a fresh run folder, scanned back by position."""
    path = write_csv(i.installs_raw, run_dir(i.spark, "csv-roundtrip") + "/user_installs.csv")
    return read_csv(i.spark, path, RAW_SCHEMAS["user_installs"])


def _with_empty_texts(df: DataFrame) -> DataFrame:
    """Every text of a length divisible by five becomes the empty text; NULL stays NULL."""
    return df.select(*[
        F.when(F.length(f.name) % 5 == 0, F.lit("")).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])


def _profile(df: DataFrame, table: str) -> DataFrame:
    """Per column: rows, NULLs, empty texts, different values, and the least and greatest text."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for k, f in enumerate(df.schema.fields):
        text = F.col(f.name) if isinstance(f.dataType, T.StringType) else F.lit(None).cast("string")
        aggs += [F.struct(
            F.lit(f.name).alias("column_name"), F.count_if(F.col(f.name).isNull()).alias("nulls"),
            F.count_if(text == "").alias("empties"), F.countDistinct(f.name).alias("kinds"),
            F.min(text).alias("least"), F.max(text).alias("greatest")).alias(f"_{k}")]
    columns = F.array(*[F.col(f"_{k}") for k in range(len(df.columns))])
    return df.agg(*aggs).select("_rows", F.explode(columns).alias("c")).select(
        F.lit(table).alias("table_name"), F.col("_rows").alias("row_count"), "c.*")


@query("csv_roundtrip_all")
def q_csv_roundtrip_all(i: Inputs) -> DataFrame:
    """All eight raw tables through CSV, with empty texts and NULLs: what comes back, column by column."""
    base = run_dir(i.spark, "csv-roundtrip-all")
    frames = []
    for name in RAW_SCHEMAS:
        path = write_csv(_with_empty_texts(i.raw(name)), f"{base}/{name}.csv")
        frames.append(_profile(read_csv(i.spark, path, RAW_SCHEMAS[name]), name))
    return reduce(DataFrame.unionByName, frames)


@query("etl_stamp")
def q_etl_stamp(i: Inputs) -> DataFrame:
    return ops.stamp(i.spend_raw, ETL_TS)


def _pipeline_run(i: Inputs, etl_ts: str | None) -> TableStore:
    """The full pipeline over CSVs of the raw tables, in a fresh run folder."""
    root = run_dir(i.spark, "pipeline")
    # One source after the other would leave the cluster idle: a write has few tasks, one per split of the events.
    side_by_side(i.spark, {name: (lambda n=name: write_csv(i.raw(n), f"{root}/sources/{n}.csv"))
                           for name in RAW_SCHEMAS})
    store = TableStore(i.spark, root + "/warehouse")
    run_pipeline(i.spark, f"{root}/sources", store, etl_ts=etl_ts, dag_execution_date=DAG_EXECUTION_DATE)
    return store


@query("pipeline_table_counts")
def q_pipeline_table_counts(i: Inputs) -> DataFrame:
    """Full pipeline over fixture CSVs; its statistics rows, without timing columns."""
    store = _pipeline_run(i, ETL_TS)
    cols = ["table_name", "etl_timestamp", "row_loaded_to_bq", "distinct_row_loaded_to_bq"]
    raw_stats = store.read(RAW_DB, RAW_STATISTICS_TABLE).select(F.lit(RAW_DB).alias("layer"), *cols)
    mart_stats = store.read(MART_DB, MART_STATISTICS_TABLE).select(F.lit(MART_DB).alias("layer"), *cols)
    return raw_stats.unionByName(mart_stats)


@query("pipeline_key_checks")
def q_pipeline_key_checks(i: Inputs) -> DataFrame:
    """Full pipeline; its record of the declared keys."""
    return _pipeline_run(i, ETL_TS).read(MART_DB, KEY_CHECKS_TABLE)


@query("run_timestamp")
def q_run_timestamp(i: Inputs) -> DataFrame:
    """Full pipeline with a run timestamp of its own: per table the rows, how many timestamps they
    carry, and whether that is the one of all tables, taken in UTC while the run went on."""
    before = datetime.now(timezone.utc)
    store = _pipeline_run(i, None)
    after = datetime.now(timezone.utc)
    tables = [(RAW_DB, name) for name in RAW_SCHEMAS] + [(MART_DB, name) for name in MART_SCHEMAS]
    rows = materialise(reduce(DataFrame.unionByName, [
        store.read(db, name).agg(F.count(F.lit(1)).alias("row_count"),
                                 F.countDistinct("etl_timestamp").alias("n_timestamps"),
                                 F.min("etl_timestamp").alias("least"), F.max("etl_timestamp").alias("greatest"))
        .select(F.lit(db).alias("layer"), F.lit(name).alias("table_name"), "*") for db, name in tables]), "timestamps")
    of_run = rows.agg((F.min("least") == F.max("greatest")).alias("one")).first()
    begun, ended = (fn.ts_literal(t.isoformat()) for t in (before, after))
    return rows.select("layer", "table_name", "row_count", "n_timestamps", F.lit(of_run["one"]).alias("one_of_run"),
                       F.coalesce(F.col("least").between(begun, ended), F.lit(True)).alias("taken_in_run"))


# --- B: projections ----------------------------------------------------------

@query("project_rename")
def q_project_rename(i: Inputs) -> DataFrame:
    kept = ops.project(i.trials_raw, "userID", "orderID", "sku", "version")
    return ops.rename(kept, {"userID": "user_id", "orderID": "order_id"})


# --- C: joins ----------------------------------------------------------------

@query("join_key_lookup")
def q_join_key_lookup(i: Inputs) -> DataFrame:
    """Plain inner join of keyed engagement rows to the app dimension (fans out on duplicate keys)."""
    keyed = facts.engagement_keyed(i.engagement_raw).select("hash_key", "country_code", "sessions")
    dim = i.app_dim.select("hash_key", F.col("package").alias("dim_package"),
                           F.col("version").alias("dim_version"))
    return ops.join_on(keyed, ops.broadcast_if_small(dim), ["hash_key"])


@query("join_key_semi")
def q_join_key_semi(i: Inputs) -> DataFrame:
    return ops.semi_lookup(facts.engagement_keyed(i.engagement_raw), i.app_dim, "hash_key")


@query("join_two_dims")
def q_join_two_dims(i: Inputs) -> DataFrame:
    keyed = facts.installs_keyed(i.installs_raw).select(
        "hash_key", "user_id", "hash_date_campaign_country", "source")
    kept = ops.semi_lookup(keyed, i.app_dim, "hash_key")
    return ops.semi_lookup(kept, i.campaign_dim, "hash_date_campaign_country")


@query("join_left_lookup")
def q_join_left_lookup(i: Inputs) -> DataFrame:
    eng = i.engagement.select("hash_key", "country_code", "sessions")
    return ops.lookup_left(eng, i.countries.select("country_code", "country"), "country_code")


@query("join_composite_key")
def q_join_composite_key(i: Inputs) -> DataFrame:
    u = i.installs.select("hash_key", "user_id", "hash_date_campaign_country", "source")
    t = i.trials.select("hash_key", "user_id", "order_id", "sku")
    return ops.join_on(u, t, ["hash_key", "user_id"])


def _installs_with_trials(i: Inputs) -> DataFrame:
    u = i.installs.select(F.col("hash_key").alias("u_hash_key"), F.col("user_id").alias("u_user_id"))
    t = marts.trials_by_day(i.trials).select(
        F.col("hash_key").alias("t_hash_key"), F.col("user_id").alias("t_user_id"), "order_id")
    return u.join(t, (F.col("u_hash_key") == F.col("t_hash_key"))
                  & (F.col("u_user_id") == F.col("t_user_id")), "inner")


@query("join_coalesced_key")
def q_join_coalesced_key(i: Inputs) -> DataFrame:
    """Ratings joined on COALESCE(install key, trial key)."""
    left = _installs_with_trials(i)
    # Stored once, so the join's size check reads a few stored rows.
    right = materialise(marts.ratings_by_day(i.ratings), "ratings-by-day")
    joined = ops.join_coalesced_key(left, right, ["u_hash_key", "t_hash_key"], "hash_key")
    return joined.select(right["hash_key"], F.col("u_user_id").alias("user_id"), "order_id",
                         "star_rating")


@query("join_coalesce_fallback")
def q_join_coalesce_fallback(i: Inputs) -> DataFrame:
    """Engagement joined on rating key = COALESCE(engagement key, install key, trial key)."""
    left = _installs_with_trials(i).select("u_hash_key", "t_hash_key", "u_user_id", "order_id")
    # Stored once: the NULL-key probe and the size check then read stored rows.
    eng = materialise(i.engagement.select(F.col("hash_key").alias("e_hash_key"), "country_code",
                                          "sessions"), "engagement-side")
    joined, _ = ops.join_coalesce_fallback(
        left, eng, left_key="u_hash_key", right_key="e_hash_key",
        fallback=F.coalesce(F.col("u_hash_key"), F.col("t_hash_key")))
    return joined.select(F.col("u_hash_key").alias("hash_key"), F.col("u_user_id").alias("user_id"),
                         "order_id", "country_code", "sessions")


@query("join_coalesce_fallback_nulls")
def q_join_coalesce_fallback_nulls(i: Inputs) -> DataFrame:
    """The same join with engagement rows that have no key where the version is missing: each of
    them pairs with every user. The pairs are formed in blocks, as for sides of any size."""
    left = materialise(_installs_with_trials(i).select("u_hash_key", "t_hash_key", "u_user_id", "order_id"), "install-orders")
    keyed = i.keyed(ky.ENGAGEMENT)
    eng = materialise(keyed.select(F.when(F.col("version").isNotNull(), F.col("hash_key")).alias("e_hash_key"),
                                   "country_code", "sessions"), "engagement-side")
    joined, _ = ops.join_coalesce_fallback(
        left, eng, left_key="u_hash_key", right_key="e_hash_key",
        fallback=F.coalesce(F.col("u_hash_key"), F.col("t_hash_key")), max_broadcast_rows=0)
    return joined.select(F.col("u_hash_key").alias("hash_key"), "e_hash_key", F.col("u_user_id").alias("user_id"),
                         "order_id", "country_code", "sessions")


@query("merged_app_users")
def q_merged_app_users(i: Inputs) -> DataFrame:
    i.prefetch(_DIMENSIONS)
    return i.lazy(marts.MERGED)


# --- D: aggregation, distinct ------------------------------------------------

@query("distinct_rows")
def q_distinct_rows(i: Inputs) -> DataFrame:
    return ops.distinct_rows(i.installs_raw.select("package", "version", "country", "campaign", "date"))


@query("group_null_key")
def q_group_null_key(i: Inputs) -> DataFrame:
    rows = ops.lookup_left(i.engagement.select("country_code"),
                           i.countries.select("country_code", "country"), "country_code")
    return rows.groupBy("country").agg(F.count(F.lit(1)).alias("row_count"))


@query("distinct_row_count")
def q_distinct_row_count(i: Inputs) -> DataFrame:
    proj = i.installs_raw.select("package", "version", "date")
    rows = ops.count_rows(proj).select(F.lit("rows").alias("metric"), F.col("row_count").alias("value"))
    distinct = ops.distinct_row_count(proj).select(
        F.lit("distinct_rows").alias("metric"), F.col("distinct_row_count").alias("value"))
    return rows.unionByName(distinct)


@query("row_and_distinct_count")
def q_row_and_distinct_count(i: Inputs) -> DataFrame:
    raw = {name: i.raw(name) for name in RAW_SCHEMAS}
    counted = side_by_side(i.spark, {name: (lambda n=name: ops.row_stats(raw[n])) for name in RAW_SCHEMAS})
    return reduce(DataFrame.unionByName, [
        counted[name].select(F.lit(name).alias("table_name"), "row_count", "distinct_row_count") for name in RAW_SCHEMAS])


@query("cte_daily_trials")
def q_cte_daily_trials(i: Inputs) -> DataFrame:
    return marts.trials_by_day(i.trials)


# --- E: set operations -------------------------------------------------------

@query("union_distinct_4")
def q_union_distinct_4(i: Inputs) -> DataFrame:
    return ops.union_distinct(
        i.engagement_raw.select("package", "version"),
        i.ratings_raw.select("package", F.col("app_version_name").alias("version")),
        i.installs_raw.select("package", "version"),
        i.trials_raw.select("package", "version"))


@query("union_distinct_2")
def q_union_distinct_2(i: Inputs) -> DataFrame:
    return ops.union_distinct(i.installs_raw.select("date", "campaign", "country"),
                              i.spend_raw.select("date", "campaign", "country"))


# --- F: scalar functions -----------------------------------------------------

@query("fn_normalize_text")
def q_fn_normalize_text(i: Inputs) -> DataFrame:
    src = i.installs_raw
    return src.select(
        "package", "campaign",
        fn.lower("package").alias("package_lower"),
        fn.squeeze_whitespace("package").alias("package_squeezed"),
        fn.trim_whitespace("package").alias("package_trimmed"),
        fn.normalize_text("package").alias("package_norm"),
        fn.normalize_text("campaign").alias("campaign_norm"),
    ).distinct()


@query("fn_concat_null")
def q_fn_concat_null(i: Inputs) -> DataFrame:
    src = i.installs_raw
    return src.select(
        "campaign", "country", "version",
        fn.concat_strict("campaign", "country").alias("strict_concat"),
        fn.concat_strict(fn.ifnull_empty("campaign"), fn.ifnull_empty("version")).alias("guarded_concat"),
        fn.coalesce("campaign", "version", F.lit("none")).alias("first_present"),
    ).distinct()


@query("fn_md5_key")
def q_fn_md5_key(i: Inputs) -> DataFrame:
    src = i.installs_raw
    return src.select(
        "package", "version",
        fn.md5_hex(fn.ifnull_empty("version")).alias("version_md5"),
        fn.md5_hex(fn.concat_strict(fn.normalize_text("package"), fn.ifnull_empty("version")))
          .alias("package_version_md5"),
    ).distinct()


@query("fn_text_all")
def q_fn_text_all(i: Inputs) -> DataFrame:
    """The text functions over every package, campaign and country of all sources."""
    texts = [i.raw(name).select(F.col("package").alias("t")) for name in
             (ky.ENGAGEMENT, ky.RATINGS, ky.INSTALLS, ky.TRIALS, "config_history")]
    texts += [i.raw(name).select(F.col(c).alias("t")) for c in ("campaign", "country") for name in (ky.INSTALLS, ky.SPEND)]
    return reduce(DataFrame.unionByName, texts).select(
        "t", fn.lower("t").alias("lowered"), fn.squeeze_whitespace("t").alias("squeezed"),
        fn.trim_whitespace("t").alias("trimmed"), fn.normalize_text("t").alias("normalized"),
        fn.md5_hex(fn.normalize_text("t")).alias("digest"),
        fn.concat_strict("t", F.lit("|"), fn.lower("t")).alias("strict_concat"),
        fn.coalesce("t", F.lit("none")).alias("present")).distinct()


@query("fn_parse_date")
def q_fn_parse_date(i: Inputs) -> DataFrame:
    src = i.spend_raw
    day = fn.parse_date("date")
    return src.select("date", day.alias("day"), fn.format_day(day).alias("day_text")).distinct()


@query("fn_parse_timestamp")
def q_fn_parse_timestamp(i: Inputs) -> DataFrame:
    return i.trials_raw.select(
        "orderID",
        fn.parse_ts_seconds("installTimestamp").alias("install_ts"),
        fn.parse_ts_fraction("installTimestamp").alias("install_ts_fraction"),
        fn.parse_ts_fraction("purchaseTimestamp").alias("purchase_ts"),
        fn.ts_literal(ETL_TS).alias("etl_timestamp"),
    )


@query("fn_day_bucket")
def q_fn_day_bucket(i: Inputs) -> DataFrame:
    day = fn.utc_day(fn.parse_ts_seconds("date"))
    return i.ratings_raw.select(day.alias("day"), fn.day_start(day).alias("day_start")).distinct()


@query("fn_round_avg")
def q_fn_round_avg(i: Inputs) -> DataFrame:
    return i.engagement_raw.groupBy("country_code").agg(
        fn.round2(F.avg("avg_session_duration")).alias("avg_duration_2dp"),
        fn.round2(F.avg(F.col("mau") / 7)).alias("avg_mau_week_2dp"))


# --- G: composite operators --------------------------------------------------

@query("app_user_key")
def q_app_user_key(i: Inputs) -> DataFrame:
    src = i.engagement_raw
    return src.select("package", "date", "version",
                      app_user_key("package", day_text_from_date("date"), "version").alias("hash_key")
                      ).distinct()


@query("campaign_key")
def q_campaign_key(i: Inputs) -> DataFrame:
    src = i.spend_raw
    return src.select("date", "campaign", "country",
                      campaign_key(day_text_from_date("date"), "campaign", "country").alias("hash_key")
                      ).distinct()


@query("app_user_key_all")
def q_app_user_key_all(i: Inputs) -> DataFrame:
    """The key of all four sources, by date and by timestamp text."""
    def rows(name: str, day: Column, date: str, version: str) -> DataFrame:
        return i.raw(name).select(F.lit(name).alias("source"), "package", F.col(date).alias("date"),
                                  F.col(version).alias("version"),
                                  app_user_key("package", day, version).alias("hash_key")).distinct()
    return reduce(DataFrame.unionByName, [
        rows(ky.ENGAGEMENT, day_text_from_date("date"), "date", "version"),
        rows(ky.RATINGS, day_text_from_ts("date"), "date", "app_version_name"),
        rows(ky.INSTALLS, day_text_from_date("date"), "date", "version"),
        rows(ky.TRIALS, day_text_from_ts("installTimestamp"), "installTimestamp", "version")])


@query("campaign_key_all")
def q_campaign_key_all(i: Inputs) -> DataFrame:
    return reduce(DataFrame.unionByName, [i.raw(name).select(
        F.lit(name).alias("source"), "date", "campaign", "country",
        campaign_key(day_text_from_date("date"), "campaign", "country").alias("hash_key")).distinct()
        for name in (ky.INSTALLS, ky.SPEND)])


@query("app_user_mapping")
def q_app_user_mapping(i: Inputs) -> DataFrame:
    return i.lazy(dims.APP_USER_DIM)


@query("date_campaign_country_mapping")
def q_date_campaign_country_mapping(i: Inputs) -> DataFrame:
    return i.lazy(dims.CAMPAIGN_DIM)


@query("app_engagement_metrics")
def q_app_engagement_metrics(i: Inputs) -> DataFrame:
    return i.lazy(facts.ENGAGEMENT)


@query("app_rating")
def q_app_rating(i: Inputs) -> DataFrame:
    return i.lazy(facts.RATING)


@query("user_installs")
def q_user_installs(i: Inputs) -> DataFrame:
    i.prefetch(_DIMENSIONS)
    return i.lazy(facts.INSTALLS)


@query("user_subscription_trials")
def q_user_subscription_trials(i: Inputs) -> DataFrame:
    return i.lazy(facts.TRIALS)


@query("ua_campaign_spendings")
def q_ua_campaign_spendings(i: Inputs) -> DataFrame:
    return i.lazy(facts.SPEND)


@query("avg_session_by_country")
def q_avg_session_by_country(i: Inputs) -> DataFrame:
    return i.lazy(marts.COUNTRY_AVERAGES)


@query("pk_duplicates")
def q_pk_duplicates(i: Inputs) -> DataFrame:
    i.prefetch(_DIMENSIONS)
    app = ops.pk_duplicates(i.app_dim, "hash_key").select(
        F.lit(dims.APP_USER_DIM).alias("table_name"), "hash_key", "row_count")
    camp = ops.pk_duplicates(i.campaign_dim, "hash_key").select(
        F.lit(dims.CAMPAIGN_DIM).alias("table_name"), "hash_key", "row_count")
    return app.unionByName(camp)


@query("fk_orphans")
def q_fk_orphans(i: Inputs) -> DataFrame:
    """Install rows whose key is missing from a dimension built from engagement alone."""
    engagement_only = materialise(dims.app_user_rows(ky.ENGAGEMENT, i.engagement_raw).distinct(),
                                  "engagement-only-dim")
    orphans = ops.fk_orphans(i.installs, engagement_only, "hash_key")
    return orphans.select("hash_key", "user_id", "hash_date_campaign_country")


@query("table_statistics", stored_facts=_MART_INPUTS, staged=ky.SOURCES)
def q_table_statistics(i: Inputs) -> DataFrame:
    """Statistics of all nine modelled tables; facts read by several are stored once."""
    i.prefetch(_DIMENSIONS, _MART_INPUTS)
    counted = side_by_side(i.spark, {name: (lambda n=name: statistics_frame(i.table(n), n, ETL_TS, DAG_EXECUTION_DATE))
                                     for name in _BUILDS})
    return reduce(DataFrame.unionByName, [counted[name] for name in _BUILDS])
