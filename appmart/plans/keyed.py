"""Raw sources with their keys: computed once, read by dimensions and facts.

A keyed source holds the natural key (G1 and, for installs, G2), what its
dimension shows of it (``package``, ``day``, ``version``; or ``day``, ``campaign``,
``country``) and its fact's columns. A step that reads a source alone uses the
lazy projection. Where several steps read it (a dimension and a fact), it is
*staged*: scanned, parsed and hashed once, and written bucketed by ``_row``, a
digest of the fact's columns.

Why by that digest and not by the key: a fact is the DISTINCT of those columns,
so it needs no exchange any more (equal rows share a bucket), and a key that
holds a third of all rows is dealt over all buckets. The key's own joins read
the fact, which is smaller, and broadcast the other side where its measured
size allows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appmart import functions as fn
from appmart.functions.keys import app_user_key, campaign_key
from appmart.session import materialise_bucketed

METRICS = ("sessions", "avg_session_duration", "dau", "wau", "mau")

ENGAGEMENT = "package_engagement_metrics"
RATINGS = "app_ratings"
INSTALLS = "user_installs"
TRIALS = "user_subscription_trials"
SPEND = "ua_campaign_spendings"

#: The columns of each source's fact; ``hash_key`` is the fact's first one.
FACT_COLUMNS: dict[str, tuple[str, ...]] = {
    ENGAGEMENT: ("hash_key", "country_code", *METRICS),
    RATINGS: ("hash_key", "date", "app_version_code", "star_rating"),
    INSTALLS: ("hash_key", "user_id", "mobile_brand_name", "mobile_marketing_name",
               "hash_date_campaign_country", "source"),
    TRIALS: ("hash_key", "user_id", "sku", "order_id", "install_timestamp", "purchase_timestamp"),
    SPEND: ("hash_key", "cost_ils"),
}


def _app(package: str, day: Column, version: str) -> list[Column]:
    return [app_user_key(package, fn.format_day(day), version).alias("hash_key"), F.col(package).alias("package"),
            fn.day_start(day).alias("day"), F.col(version).alias("version")]


def _engagement(raw: DataFrame) -> DataFrame:
    return raw.select(*_app("package", fn.parse_date("date"), "version"), "country_code", *METRICS)


def _ratings(raw: DataFrame) -> DataFrame:
    rated = fn.parse_ts_seconds("date")
    return raw.select(*_app("package", fn.utc_day(rated), "app_version_name"), rated.alias("date"),
                      "app_version_code", "star_rating")


def _installs(raw: DataFrame) -> DataFrame:
    day = fn.parse_date("date")
    return raw.select(
        *_app("package", day, "version"), "campaign", "country",
        campaign_key(fn.format_day(day), "campaign", "country").alias("hash_date_campaign_country"),
        "user_id", "mobile_brand_name", "mobile_marketing_name", "source")


def _trials(raw: DataFrame) -> DataFrame:
    """Keyed by install day: whole seconds in the key, fractions allowed in columns."""
    return raw.select(
        *_app("package", fn.utc_day(fn.parse_ts_seconds("installTimestamp")), "version"),
        F.col("userID").alias("user_id"), "sku", F.col("orderID").alias("order_id"),
        fn.parse_ts_fraction("installTimestamp").alias("install_timestamp"),
        fn.parse_ts_fraction("purchaseTimestamp").alias("purchase_timestamp"))


def _spend(raw: DataFrame) -> DataFrame:
    day = fn.parse_date("date")
    return raw.select(
        campaign_key(fn.format_day(day), "campaign", "country").alias("hash_key"),
        fn.day_start(day).alias("day"), "campaign", "country", F.col("costILS").alias("cost_ils"))


_KEYED: dict[str, Callable[[DataFrame], DataFrame]] = {
    ENGAGEMENT: _engagement, RATINGS: _ratings, INSTALLS: _installs, TRIALS: _trials, SPEND: _spend}

SOURCES = tuple(_KEYED)


def keyed(source: str, df: DataFrame) -> DataFrame:
    """The keyed form of a raw source; a frame that is keyed already stays as it is."""
    return df if "hash_key" in df.columns else _KEYED[source](df)


def stage(source: str, raw: DataFrame) -> DataFrame:
    """The keyed source, stored in buckets of ``_row``."""
    rows = keyed(source, raw)
    # NULL flags as well: a hash passes over NULLs, and columns of NULLs shall spread too.
    parts = [x for c in FACT_COLUMNS[source] for x in (F.col(c), F.col(c).isNull())]
    return materialise_bucketed(rows.withColumn("_row", F.xxhash64(*parts)), f"keyed-{source}", "_row")


def fact_rows(source: str, df: DataFrame) -> DataFrame:
    """The DISTINCT fact rows of a raw or keyed source; of a staged one without an exchange.

    Grouping by the digest *and* the columns is exact whatever digests clash.
    """
    rows = keyed(source, df)
    bucket = ["_row"] if "_row" in rows.columns else []
    return rows.select(*bucket, *FACT_COLUMNS[source]).distinct().select(*FACT_COLUMNS[source])
