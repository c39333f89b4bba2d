"""Hashed natural keys of the two dimensions.

A key is the MD5 of normalised parts concatenated without a separator, so
``('ab', 'c')`` and ``('a', 'bc')`` collide, and NULL hashes like ''. That is
the mart's defined key, kept as is; ``sep`` exists for callers who want a
collision-free variant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from appmart import functions as fn


def day_text_from_date(text: Column | str) -> Column:
    """``yyyy-MM-dd`` text of a date string (NULL stays NULL)."""
    return fn.format_day(fn.parse_date(text))


def day_text_from_ts(text: Column | str) -> Column:
    """``yyyy-MM-dd`` UTC day of a whole-second timestamp string."""
    return fn.format_day(fn.utc_day(fn.parse_ts_seconds(text)))


def app_user_key(package: Column | str, day_text: Column | str, version: Column | str,
                 sep: str = "") -> Column:
    """Key of one app package on one day at one version.

    The package is normalised (lower, squeezed, trimmed); the version is not.
    """
    parts = [fn.normalize_text(package), fn.ifnull_empty(day_text), fn.ifnull_empty(version)]
    if sep:
        parts = [parts[0], F.lit(sep), parts[1], F.lit(sep), parts[2]]
    return fn.md5_hex(fn.concat_strict(*parts))


def campaign_key(day_text: Column | str, campaign: Column | str, country: Column | str,
                 sep: str = "") -> Column:
    """Key of one campaign in one country on one day; campaign and country normalised."""
    parts = [fn.ifnull_empty(day_text), fn.normalize_text(campaign), fn.normalize_text(country)]
    if sep:
        parts = [parts[0], F.lit(sep), parts[1], F.lit(sep), parts[2]]
    return fn.md5_hex(fn.concat_strict(*parts))
