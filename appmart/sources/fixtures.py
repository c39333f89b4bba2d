"""Raw app tables derived from the shared test tables (``events``, ``nation``).

The test data has no app files, so each raw table is a projection (or, for
engagement, an aggregation) of one event type. Values are chosen to
exercise the key rules: mixed case and stray whitespace in package names,
empty and missing packages, versions, users, dates and ratings, campaign names
that differ only in case and spacing, codes without a country, fractions of
three, seven and nine digits. Every adapter reads the whole ``events`` table, so its
work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appmart.operators import conform
from appmart.schemas import RAW_SCHEMAS


def _s(c: Column) -> Column:
    return c.cast("string")


def events(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df if kind is None else df.where(F.col("event_type") == kind)


def _on(every: int) -> Column:
    """Every so many events; the numbers below are primes, so the odd cases also meet."""
    return F.col("event_id") % every == 0


def _none() -> Column:
    return F.lit(None).cast("string")


def package_text() -> Column:
    """Package name; every third event spells it with capitals and extra blanks, some with a tab,
    some have an empty one or none."""
    app = _s(F.col("user_id") % 4)
    return (F.when(_on(97), _none()).when(_on(89), F.lit("")).when(_on(83), F.concat(F.lit("com.app\t"), app))
            .when(_on(3), F.concat(F.lit("  Com.App  "), app, F.lit(" ")))
            .otherwise(F.concat(F.lit("com.app "), app)))


def version_text() -> Column:
    """App version; none on every fiftieth event, an empty one on some."""
    return (F.when(_on(50), _none()).when(_on(53), F.lit(""))
            .otherwise(F.concat(F.lit("1."), _s(F.col("user_id") % 3))))


def user_text() -> Column:
    """User; some events have none."""
    return F.when(~_on(103), _s(F.col("user_id")))


def day_text() -> Column:
    return F.when(~_on(107), F.date_format("ts", "yyyy-MM-dd"))


def ts_utc_text() -> Column:
    return F.when(~_on(109), F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))


def ts_millis_utc_text() -> Column:
    """Milliseconds; every second event writes them with nine digits, every fifth with seven."""
    more = F.when(_on(2), F.lit("000000")).when(_on(5), F.lit("0000")).otherwise(F.lit(""))
    return F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), more, F.lit(" UTC"))


def engagement_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """package_engagement_metrics: click events per package, day, country code, version."""
    clicks = events(spark, sf_dir, "click")
    grouped = clicks.groupBy(
        package_text().alias("package"),
        day_text().alias("date"),
        F.concat(F.lit("N"), _s(F.col("user_id") % 27)).alias("country_code"),
        version_text().alias("version"),
    ).agg(
        F.count(F.lit(1)).cast("double").alias("sessions"),
        F.avg(F.floor(F.col("value") * 8) / 8).alias("avg_session_duration"),
        F.countDistinct("user_id").cast("double").alias("dau"),
        F.max(F.col("event_id") % 100).cast("double").alias("wau"),
        F.max(F.col("event_id") % 1000).cast("double").alias("mau"),
    )
    return conform(grouped, RAW_SCHEMAS["package_engagement_metrics"])


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app_ratings: one rating per view event."""
    views = events(spark, sf_dir, "view")
    return conform(views.select(
        package_text().alias("package_name"),
        (F.col("user_id") % 3).cast("double").alias("app_version_code"),
        version_text().alias("app_version_name"),
        F.when(~_on(61), F.col("event_id") % 5 + 1).alias("star_rating"),
        ts_utc_text().alias("date"),
        package_text().alias("package"),
    ), RAW_SCHEMAS["app_ratings"])


def installs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_installs: one install per signup event."""
    signups = events(spark, sf_dir, "signup")
    return conform(signups.select(
        package_text().alias("package"),
        user_text().alias("user_id"),
        F.concat(F.lit("fp"), _s(F.col("event_id") % 8)).alias("firebase_partition"),
        F.concat(F.lit("brand_"), _s(F.col("user_id") % 6)).alias("mobile_brand_name"),
        F.concat(F.lit("model_"), _s(F.col("user_id") % 11)).alias("mobile_marketing_name"),
        version_text().alias("version"),
        F.concat(F.lit("NATION_"), _s(F.col("user_id") % 27)).alias("country"),
        F.when(F.col("event_id") % 40 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Camp "), _s(F.col("event_id") % 5))).alias("campaign"),
        F.when(F.col("event_id") % 2 == 0, F.lit("org")).otherwise(F.lit("paid")).alias("source"),
        day_text().alias("date"),
    ), RAW_SCHEMAS["user_installs"])


def trials_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_subscription_trials: one trial per purchase event."""
    purchases = events(spark, sf_dir, "purchase")
    return conform(purchases.select(
        ts_utc_text().alias("installTimestamp"),
        ts_millis_utc_text().alias("purchaseTimestamp"),
        package_text().alias("packageName"),
        user_text().alias("userID"),
        F.concat(F.lit("sku"), _s(F.col("event_id") % 7)).alias("sku"),
        _s(F.col("event_id")).alias("orderID"),
        F.concat(F.lit("tok"), _s(F.col("event_id"))).alias("purchaseToken"),
        F.col("value").alias("fcmToken"),
        version_text().alias("version"),
        package_text().alias("package"),
    ), RAW_SCHEMAS["user_subscription_trials"])


def spend_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ua_campaign_spendings: one spend per error event; names differ in case and spacing."""
    errors = events(spark, sf_dir, "error")
    return conform(errors.select(
        day_text().alias("date"),
        F.concat(F.lit("camp  "), _s(F.col("event_id") % 5)).alias("campaign"),
        F.concat(F.lit("nation_"), _s(F.col("user_id") % 27)).alias("country"),
        F.col("value").alias("costILS"),
    ), RAW_SCHEMAS["ua_campaign_spendings"])


def countries_raw(spark: SparkSession, sf_dir: str,
                  table: str = "country_code_to_name") -> DataFrame:
    """country_code_to_name / country_names_to_code from ``nation``."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return conform(nation.select(
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), _s(F.col("n_nationkey"))).alias("country_code"),
        F.concat(F.lit("N0"), _s(F.col("n_nationkey"))).alias("country_code_3"),
    ), RAW_SCHEMAS[table])


def config_history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """config_history: one config change per event (loaded and counted only)."""
    return conform(events(spark, sf_dir).select(
        package_text().alias("package"),
        F.col("event_type").alias("param_name"),
        (F.col("event_id") % 10).alias("version"),
        F.lit("fixture").alias("created_by"),
        ts_utc_text().alias("created_at"),
        ts_utc_text().alias("published_at"),
        F.lit("remote_config").alias("type"),
        F.col("props").alias("config_values"),
    ), RAW_SCHEMAS["config_history"])


RAW_BUILDERS = {
    "app_ratings": ratings_raw,
    "config_history": config_history_raw,
    "country_code_to_name": countries_raw,
    "country_names_to_code": lambda spark, d: countries_raw(spark, d, "country_names_to_code"),
    "package_engagement_metrics": engagement_raw,
    "ua_campaign_spendings": spend_raw,
    "user_installs": installs_raw,
    "user_subscription_trials": trials_raw,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight raw tables, lazily."""
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
