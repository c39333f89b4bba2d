"""Scalar Column functions the mart's keys and tables are built from.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen on the executors; none is a Python UDF.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: text patterns the source formats are parsed with.
# ASCII whitespace squeezed inside keys (space, tab, newline, form feed,
# carriage return); vertical tab is deliberately not in the set.
INNER_WHITESPACE = "[\\t\\n\\f\\r ]+"
# Leading/trailing whitespace of any Unicode kind.
OUTER_WHITESPACE = "^\\p{IsWhite_Space}+|\\p{IsWhite_Space}+$"
# Calendar dates: 4-digit year, month and day with one or two digits.
DATE_PATTERN = "yyyy-M-d"
# Timestamps with whole seconds and a zone name, e.g. 2024-01-05 03:04:05 UTC.
TS_SECONDS_PATTERN = "yyyy-M-d H:m:s VV"
# The same with an optional fraction of up to six digits.
MORE_THAN_MICROS = r"(:[0-9]{1,2}\.[0-9]{6})[0-9]{1,3}(?= )"
TS_FRACTION_PATTERN = "yyyy-M-d H:m:s[.SSSSSS] VV"
# Canonical day text inside keys.
DAY_TEXT_PATTERN = "yyyy-MM-dd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ifnull_empty(c: Column | str) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def lower(c: Column | str) -> Column:
    """Lower-case (F1)."""
    return F.lower(_col(c))


def squeeze_whitespace(c: Column | str) -> Column:
    """Replace every run of ASCII whitespace with one space (F2)."""
    return F.regexp_replace(_col(c), INNER_WHITESPACE, " ")


def trim_whitespace(c: Column | str) -> Column:
    """Strip leading and trailing whitespace of any Unicode kind."""
    return F.regexp_replace(_col(c), OUTER_WHITESPACE, "")


def normalize_text(c: Column | str) -> Column:
    """Key normalisation of free text: NULL→'', lower, squeeze, trim."""
    return trim_whitespace(squeeze_whitespace(lower(ifnull_empty(c))))


def concat_strict(*cols: Column | str) -> Column:
    """Concatenate without separator; any NULL input gives NULL."""
    return F.concat(*[_col(c) for c in cols])


def coalesce(*cols: Column | str) -> Column:
    """First non-NULL argument."""
    return F.coalesce(*[_col(c) for c in cols])


def md5_hex(c: Column | str) -> Column:
    """32-char lower-case hex MD5 of the UTF-8 bytes."""
    return F.md5(_col(c))


def parse_date(c: Column | str) -> Column:
    """Parse a ``yyyy-M-d`` date; outer blanks allowed, bad text fails the job."""
    return F.to_date(F.trim(_col(c)), DATE_PATTERN)


def format_day(d: Column | str) -> Column:
    """Date or timestamp as ``yyyy-MM-dd`` text."""
    return F.date_format(_col(d), DAY_TEXT_PATTERN)


def parse_ts_seconds(c: Column | str) -> Column:
    """Parse ``y-M-d H:m:s ZONE`` with whole seconds; a fraction fails the job."""
    return F.to_timestamp(F.trim(_col(c)), TS_SECONDS_PATTERN)


def parse_ts_fraction(c: Column | str) -> Column:
    """Parse ``y-M-d H:m:s[.fffffffff] ZONE`` with an optional fraction.

    Timestamps hold microseconds; digits 7 to 9 of a fraction are cut off.
    """
    return F.to_timestamp(F.regexp_replace(F.trim(_col(c)), MORE_THAN_MICROS, "$1"), TS_FRACTION_PATTERN)


def ts_literal(text: str) -> Column:
    """An ISO-8601 timestamp text (offset and fraction optional) as a literal."""
    return F.lit(text).cast("timestamp")


def utc_day(ts: Column | str) -> Column:
    """Calendar day of an instant, in UTC (F15; session time zone is UTC)."""
    return F.to_date(_col(ts))


def day_start(d: Column | str) -> Column:
    """Midnight UTC of a date, as a timestamp (F16)."""
    return F.to_timestamp(_col(d))


def round2(c: Column | str) -> Column:
    """Round half away from zero to two decimals."""
    return F.round(_col(c), 2)


def new_etl_ts(now: datetime | None = None) -> str:
    """One run timestamp, UTC, ISO-8601 with offset (A10).

    Taken once on the driver and passed to every table as a literal, so all
    tables of a run carry the same value.
    """
    now = now or datetime.now(timezone.utc)
    return now.astimezone(timezone.utc).isoformat()
