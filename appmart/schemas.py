"""Schema registry: every table the mart reads or writes, declared up front.

Raw files are bound to these schemas by position; nothing is inferred.
All columns are nullable, integers are 64-bit, floats are doubles, and
timestamps are UTC instants.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

# --- Fixed values: raw input schemas (column names, order and types of the
# --- source files; must stay as declared for positional binding).
RAW_SCHEMAS: dict[str, T.StructType] = {
    "app_ratings": _schema(
        ("package_name", S), ("app_version_code", D), ("app_version_name", S),
        ("star_rating", L), ("date", S), ("package", S)),
    "config_history": _schema(
        ("package", S), ("param_name", S), ("version", L), ("created_by", S),
        ("created_at", S), ("published_at", S), ("type", S), ("config_values", S)),
    "country_code_to_name": _schema(
        ("country", S), ("country_code", S), ("country_code_3", S)),
    "country_names_to_code": _schema(
        ("country", S), ("country_code", S), ("country_code_3", S)),
    "package_engagement_metrics": _schema(
        ("package", S), ("date", S), ("country_code", S), ("version", S),
        ("sessions", D), ("avg_session_duration", D), ("dau", D), ("wau", D), ("mau", D)),
    "ua_campaign_spendings": _schema(
        ("date", S), ("campaign", S), ("country", S), ("costILS", D)),
    "user_installs": _schema(
        ("package", S), ("user_id", S), ("firebase_partition", S), ("mobile_brand_name", S),
        ("mobile_marketing_name", S), ("version", S), ("country", S), ("campaign", S),
        ("source", S), ("date", S)),
    "user_subscription_trials": _schema(
        ("installTimestamp", S), ("purchaseTimestamp", S), ("packageName", S), ("userID", S),
        ("sku", S), ("orderID", S), ("purchaseToken", S), ("fcmToken", D), ("version", S),
        ("package", S)),
}

# --- Fixed values: load-statistics schema (same for both layers).
STATISTICS_SCHEMA = _schema(
    ("table_name", S), ("dag_execution_date", TS), ("load_to_bq_timestamp", TS),
    ("etl_timestamp", TS), ("duration_loading_to_bq_min", D), ("row_loaded_to_bq", L),
    ("distinct_row_loaded_to_bq", L))

RAW_STATISTICS_TABLE = "statistics_drive_to_bq"
MART_STATISTICS_TABLE = "statistics_analytics"

KEY_CHECKS_TABLE = "key_checks"
KEY_CHECKS_SCHEMA = _schema(
    ("table_name", S), ("constraint_type", S), ("column_name", S), ("reference_table", S),
    ("dag_execution_date", TS), ("etl_timestamp", TS), ("violations", L))

# --- Fixed values: modelled output schemas, in column order.
MART_SCHEMAS: dict[str, T.StructType] = {
    "app_user_mapping_hash_key": _schema(
        ("hash_key", S), ("package", S), ("date", TS), ("version", S), ("etl_timestamp", TS)),
    "date_campaign_country_mapping_hash_key": _schema(
        ("hash_key", S), ("date", TS), ("campaign", S), ("country", S), ("etl_timestamp", TS)),
    "app_engagement_metrics": _schema(
        ("hash_key", S), ("country_code", S), ("sessions", D), ("avg_session_duration", D),
        ("dau", D), ("wau", D), ("mau", D), ("etl_timestamp", TS)),
    "app_rating": _schema(
        ("hash_key", S), ("date", TS), ("app_version_code", D), ("star_rating", L),
        ("etl_timestamp", TS)),
    "user_installs": _schema(
        ("hash_key", S), ("user_id", S), ("mobile_brand_name", S), ("mobile_marketing_name", S),
        ("hash_date_campaign_country", S), ("source", S), ("etl_timestamp", TS)),
    "user_subscription_trials": _schema(
        ("hash_key", S), ("user_id", S), ("sku", S), ("order_id", S),
        ("install_timestamp", TS), ("purchase_timestamp", TS), ("etl_timestamp", TS)),
    "ua_campaign_spendings": _schema(
        ("hash_key", S), ("cost_ils", D), ("etl_timestamp", TS)),
    "merged_app_users": _schema(
        ("hash_key", S), ("user_id", S), ("hash_date_campaign_country", S), ("order_id", S),
        ("star_rating", L), ("country_code", S), ("sessions", D), ("avg_session_duration", D),
        ("dau", D), ("wau", D), ("mau", D), ("etl_timestamp", TS)),
    "avg_session_by_country": _schema(
        ("country", S), ("avg_session_duration_by_country", D), ("avg_session_by_country", D),
        ("avg_dau_by_country", D), ("avg_wau_by_country", D), ("avg_mau_by_country", D),
        ("etl_timestamp", TS)),
}

def raw_schema(table: str) -> T.StructType:
    """Schema of a raw source table; unknown names are an error, not an empty schema."""
    try:
        return RAW_SCHEMAS[table]
    except KeyError:
        raise KeyError(f"no declared schema for source table {table!r}; "
                       f"known: {sorted(RAW_SCHEMAS)}") from None


def stamped(schema: T.StructType) -> T.StructType:
    """A raw schema plus the run-timestamp column every loaded table gains."""
    return T.StructType(list(schema.fields) + [T.StructField("etl_timestamp", TS, True)])
