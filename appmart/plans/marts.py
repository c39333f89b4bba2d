"""The two marts: merged app users (G10) and per-country averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appmart.operators import conform, group_avg, join_on, join_spread, lookup_left, stamp
from appmart.schemas import MART_SCHEMAS
from appmart.session import materialise

MERGED = "merged_app_users"
COUNTRY_AVERAGES = "avg_session_by_country"

ENGAGEMENT_COLUMNS = ("country_code", "sessions", "avg_session_duration", "dau", "wau", "mau")


def trials_by_day(trials: DataFrame) -> DataFrame:
    """Distinct (hash_key, user_id, order_id) of the trials fact (D7, first CTE)."""
    return trials.select("hash_key", "user_id", "order_id").distinct()


def ratings_by_day(ratings: DataFrame) -> DataFrame:
    """Distinct (hash_key, star_rating) of the ratings fact (D7, second CTE)."""
    return ratings.select("hash_key", "star_rating").distinct()


def build_merged_app_users(installs: DataFrame, trials: DataFrame, ratings: DataFrame,
                           engagement: DataFrame, etl_ts: str) -> DataFrame:
    """Users with an install and a trial on one app-user key, crossed with the
    key's distinct star ratings and engagement rows (G10).

    Semantics: installs ⋈ trials on (hash_key, user_id); ratings on the
    install's key; engagement on ``rating key = COALESCE(engagement key,
    install key, trial key)``; DISTINCT over the twelve output columns. Since
    the day is in the key, only same-day pairs meet.

    Plan:

    * Each input is reduced to the distinct values of the columns it
      contributes *before* joining. For a fixed key, the output is then the
      product of three duplicate-free sets — (user, campaign key, order),
      star ratings, engagement rows — so it is already duplicate-free and the
      twelve-column DISTINCT over the largest intermediate (a full shuffle of
      the output) is not needed.
    * Keys of the conformed facts are MD5 values and never NULL, so the
      COALESCE of the join condition is the engagement key itself and the
      join is a plain equi-join.
    * installs ⋈ trials is a shuffle join on (hash_key, user_id), so a hot
      app-day key still spreads over its users; a hot (key, user) partition
      is split at runtime by AQE's skew-join handling.
    * Stars and engagement rows are joined per key first and stored. That side
      is broadcast when its size check passes, so the growing product is
      never shuffled. Over the bound the pairs are shuffled once more, by key
      and a part chosen by user and order, so that a hot key's output is made
      by several tasks (see ``join_spread``).
    """
    users = installs.select("hash_key", "user_id", "hash_date_campaign_country").distinct()
    paired = join_on(users, trials_by_day(trials), ["hash_key", "user_id"])
    metrics = engagement.select("hash_key", *ENGAGEMENT_COLUMNS).distinct()
    per_key = materialise(join_on(ratings_by_day(ratings), metrics, ["hash_key"]), "merged-per-key")
    merged = join_spread(paired, per_key, ["hash_key"], ["user_id", "order_id"])
    return conform(stamp(merged, etl_ts), MART_SCHEMAS[MERGED])


def build_country_averages(engagement: DataFrame, countries: DataFrame, etl_ts: str) -> DataFrame:
    """Per country name, the rounded mean of each engagement metric.

    Engagement rows whose code has no country fall in the NULL group; a code
    listed twice in the lookup counts its rows twice.
    """
    rows = lookup_left(engagement.select(*ENGAGEMENT_COLUMNS),
                       countries.select("country_code", "country"), on="country_code")
    averages = group_avg(rows, "country", {
        "avg_session_duration_by_country": "avg_session_duration",
        "avg_session_by_country": "sessions",
        "avg_dau_by_country": "dau",
        "avg_wau_by_country": "wau",
        "avg_mau_by_country": "mau",
    })
    return conform(stamp(averages, etl_ts), MART_SCHEMAS[COUNTRY_AVERAGES])
