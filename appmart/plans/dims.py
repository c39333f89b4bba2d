"""The two hashed natural-key dimensions.

Each dimension keeps the *raw* text next to the normalised key, so one key
can have several rows (``Foo`` and ``foo `` share a key). That is the
defined content, kept as is; :func:`appmart.operators.pk_duplicates` reports it.
Builders take raw sources or their keyed form (see ``keyed``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appmart.operators import conform, stamp, union_distinct
from appmart.plans import keyed as ky
from appmart.schemas import MART_SCHEMAS

APP_USER_DIM = "app_user_mapping_hash_key"
CAMPAIGN_DIM = "date_campaign_country_mapping_hash_key"


def app_user_rows(source: str, df: DataFrame) -> DataFrame:
    """(hash_key, package, date, version) of a source; trials are dated by install time."""
    return ky.keyed(source, df).select("hash_key", "package", F.col("day").alias("date"), "version")


def campaign_rows(source: str, df: DataFrame) -> DataFrame:
    """(hash_key, date, campaign, country) of installs or spendings."""
    key = "hash_date_campaign_country" if source == ky.INSTALLS else "hash_key"
    return ky.keyed(source, df).select(F.col(key).alias("hash_key"), F.col("day").alias("date"), "campaign", "country")


def app_user_union(engagement: DataFrame, ratings: DataFrame, installs: DataFrame,
                   trials: DataFrame) -> DataFrame:
    """Distinct app-user rows of the four sources."""
    return union_distinct(app_user_rows(ky.ENGAGEMENT, engagement), app_user_rows(ky.RATINGS, ratings),
                          app_user_rows(ky.INSTALLS, installs), app_user_rows(ky.TRIALS, trials))


def build_app_user_dim(engagement: DataFrame, ratings: DataFrame, installs: DataFrame,
                       trials: DataFrame, etl_ts: str) -> DataFrame:
    """App/day/version dimension.

    The run timestamp is one constant, so it is added after the distinct:
    same rows, narrower shuffle.
    """
    rows = app_user_union(engagement, ratings, installs, trials)
    return conform(stamp(rows, etl_ts), MART_SCHEMAS[APP_USER_DIM])


def build_campaign_dim(installs: DataFrame, spend: DataFrame, etl_ts: str) -> DataFrame:
    """Day/campaign/country dimension from installs and spendings."""
    rows = union_distinct(campaign_rows(ky.INSTALLS, installs), campaign_rows(ky.SPEND, spend))
    return conform(stamp(rows, etl_ts), MART_SCHEMAS[CAMPAIGN_DIM])
