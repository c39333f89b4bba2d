"""Fact tables conformed to the key dimensions.

Each fact is the distinct rows of its keyed source (see ``keyed``) whose key is in
the dimension. Duplicates go first, spread evenly over all columns; the
semi-join then has the smaller set, so no raw rows are exchanged by a skewed
key. It is a semi-join as only the key is taken from the dimension: a key the
dimension holds twice does not duplicate rows. Builders take a raw source or
its keyed form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from appmart.operators import conform, semi_lookup, stamp
from appmart.plans import keyed as ky
from appmart.schemas import MART_SCHEMAS

ENGAGEMENT = "app_engagement_metrics"
RATING = "app_rating"
INSTALLS = "user_installs"
TRIALS = "user_subscription_trials"
SPEND = "ua_campaign_spendings"


def _finish(rows: DataFrame, table: str, etl_ts: str) -> DataFrame:
    return conform(stamp(rows, etl_ts), MART_SCHEMAS[table])


def keyed_rows(source: str, df: DataFrame) -> DataFrame:
    """The fact's columns of a source, duplicates included."""
    return ky.keyed(source, df).select(*ky.FACT_COLUMNS[source])


def engagement_keyed(raw: DataFrame) -> DataFrame:
    return keyed_rows(ky.ENGAGEMENT, raw)


def installs_keyed(raw: DataFrame) -> DataFrame:
    return keyed_rows(ky.INSTALLS, raw)


def spend_keyed(raw: DataFrame) -> DataFrame:
    return keyed_rows(ky.SPEND, raw)


def build_engagement(source: DataFrame, app_dim: DataFrame, etl_ts: str) -> DataFrame:
    """Engagement metrics per app-user key and country."""
    return _finish(semi_lookup(ky.fact_rows(ky.ENGAGEMENT, source), app_dim, "hash_key"), ENGAGEMENT, etl_ts)


def build_ratings(source: DataFrame, app_dim: DataFrame, etl_ts: str) -> DataFrame:
    """Ratings keyed by package, UTC day of the rating and version name."""
    return _finish(semi_lookup(ky.fact_rows(ky.RATINGS, source), app_dim, "hash_key"), RATING, etl_ts)


def build_installs(source: DataFrame, app_dim: DataFrame, campaign_dim: DataFrame,
                   etl_ts: str) -> DataFrame:
    """Installs keyed by app-user and by day/campaign/country."""
    kept = semi_lookup(ky.fact_rows(ky.INSTALLS, source), app_dim, "hash_key")
    kept = semi_lookup(kept, campaign_dim, "hash_date_campaign_country")
    return _finish(kept, INSTALLS, etl_ts)


def build_trials(source: DataFrame, app_dim: DataFrame, etl_ts: str) -> DataFrame:
    """Subscription trials keyed by the install's app-user key."""
    return _finish(semi_lookup(ky.fact_rows(ky.TRIALS, source), app_dim, "hash_key"), TRIALS, etl_ts)


def build_spend(source: DataFrame, campaign_dim: DataFrame, etl_ts: str) -> DataFrame:
    """Campaign spend per day/campaign/country key.

    Equal spends on one key collapse to one row: that is the defined DISTINCT.
    """
    return _finish(semi_lookup(ky.fact_rows(ky.SPEND, source), campaign_dim, "hash_key"), SPEND, etl_ts)
