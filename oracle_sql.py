"""DuckDB oracle SQL for every registered query.

Every source is keyed once; dimensions are grouped unions, facts keep rows
whose key is a member of the dimension, the merged mart combines one set per
key with another. The tables
``events`` and ``nation`` are views over the same parquet files.
Timestamps are naive UTC ``TIMESTAMP`` values; rounding goes through
DECIMAL so that halves round away from zero on the decimal value.
"""

from __future__ import annotations

ETL = "TIMESTAMP '2024-02-01 06:30:00.25'"
DAG = "TIMESTAMP '2024-02-01 06:00:00'"


def norm(x: str) -> str:
    return rf"trim(regexp_replace(lower(coalesce({x}, '')), '[\t\n\f\r ]+', ' ', 'g'))"


def day_of_date(x: str) -> str:
    return f"strftime(CAST({x} AS DATE), '%Y-%m-%d')"


def ts_of_text(x: str) -> str:
    return f"strptime({x}, '%Y-%m-%d %H:%M:%S UTC')"


def ts_ms_of_text(x: str) -> str:
    """The digits after the third are zeros."""
    return rf"strptime(regexp_replace({x}, '(\.[0-9]{{3}})0+ ', '\1 '), '%Y-%m-%d %H:%M:%S.%g UTC')"


def day_of_ts_text(x: str) -> str:
    return f"strftime(CAST({ts_of_text(x)} AS DATE), '%Y-%m-%d')"


def app_key(pkg: str, day: str, ver: str) -> str:
    return f"md5({norm(pkg)} || coalesce({day}, '') || coalesce({ver}, ''))"


def camp_key(day: str, camp: str, ctry: str) -> str:
    return f"md5(coalesce({day}, '') || {norm(camp)} || {norm(ctry)})"


def round2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38, 10)), 2) AS DOUBLE)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


cte("ev", (), r"""
  SELECT event_id, ts, user_id, event_type, value, props,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 89 = 0 THEN ''
         WHEN event_id % 83 = 0 THEN 'com.app' || chr(9) || CAST(user_id % 4 AS VARCHAR)
         WHEN event_id % 3 = 0 THEN '  Com.App  ' || CAST(user_id % 4 AS VARCHAR) || ' '
         ELSE 'com.app ' || CAST(user_id % 4 AS VARCHAR) END AS pkg,
    CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 53 = 0 THEN ''
         ELSE '1.' || CAST(user_id % 3 AS VARCHAR) END AS ver,
    CASE WHEN event_id % 103 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
    CASE WHEN event_id % 61 <> 0 THEN CAST(event_id % 5 + 1 AS BIGINT) END AS stars,
    CASE WHEN event_id % 107 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day_s,
    CASE WHEN event_id % 109 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS tsu,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || CASE WHEN event_id % 2 = 0 THEN '000000'
      WHEN event_id % 5 = 0 THEN '0000' ELSE '' END || ' UTC' AS tsm
  FROM events""")

cte("raw_engagement", ("ev",), """
  SELECT pkg AS package, day_s AS date, 'N' || CAST(user_id % 27 AS VARCHAR) AS country_code,
         ver AS version,
         CAST(count(*) AS DOUBLE) AS sessions,
         avg(floor(value * 8) / 8) AS avg_session_duration,
         CAST(count(DISTINCT user_id) AS DOUBLE) AS dau,
         CAST(max(event_id % 100) AS DOUBLE) AS wau,
         CAST(max(event_id % 1000) AS DOUBLE) AS mau
  FROM ev WHERE event_type = 'click'
  GROUP BY pkg, day_s, 'N' || CAST(user_id % 27 AS VARCHAR), ver""")

cte("raw_ratings", ("ev",), """
  SELECT pkg AS package_name, CAST(user_id % 3 AS DOUBLE) AS app_version_code,
         ver AS app_version_name, stars AS star_rating,
         tsu AS date, pkg AS package
  FROM ev WHERE event_type = 'view'""")

cte("raw_installs", ("ev",), """
  SELECT pkg AS package, uid AS user_id,
         'fp' || CAST(event_id % 8 AS VARCHAR) AS firebase_partition,
         'brand_' || CAST(user_id % 6 AS VARCHAR) AS mobile_brand_name,
         'model_' || CAST(user_id % 11 AS VARCHAR) AS mobile_marketing_name,
         ver AS version, 'NATION_' || CAST(user_id % 27 AS VARCHAR) AS country,
         CASE WHEN event_id % 40 = 0 THEN NULL ELSE 'Camp ' || CAST(event_id % 5 AS VARCHAR) END AS campaign,
         CASE WHEN event_id % 2 = 0 THEN 'org' ELSE 'paid' END AS source,
         day_s AS date
  FROM ev WHERE event_type = 'signup'""")

cte("raw_trials", ("ev",), """
  SELECT tsu AS installTimestamp, tsm AS purchaseTimestamp, pkg AS packageName,
         uid AS userID, 'sku' || CAST(event_id % 7 AS VARCHAR) AS sku,
         CAST(event_id AS VARCHAR) AS orderID, 'tok' || CAST(event_id AS VARCHAR) AS purchaseToken,
         value AS fcmToken, ver AS version, pkg AS package
  FROM ev WHERE event_type = 'purchase'""")

cte("raw_spend", ("ev",), """
  SELECT day_s AS date, 'camp  ' || CAST(event_id % 5 AS VARCHAR) AS campaign,
         'nation_' || CAST(user_id % 27 AS VARCHAR) AS country, value AS costILS
  FROM ev WHERE event_type = 'error'""")

cte("raw_countries", (), """
  SELECT n_name AS country, 'N' || CAST(n_nationkey AS VARCHAR) AS country_code,
         'N0' || CAST(n_nationkey AS VARCHAR) AS country_code_3
  FROM nation""")

cte("raw_config", ("ev",), """
  SELECT pkg AS package, event_type AS param_name, CAST(event_id % 10 AS BIGINT) AS version,
         'fixture' AS created_by, tsu AS created_at, tsu AS published_at,
         'remote_config' AS type, props AS config_values
  FROM ev""")

# Each source once with its keys; everything modelled reads these.
cte("keyed_engagement", ("raw_engagement",), f"""
  SELECT *, CAST(CAST(date AS DATE) AS TIMESTAMP) AS day_ts,
         {app_key('package', day_of_date('date'), 'version')} AS app_k
  FROM raw_engagement""")

cte("keyed_ratings", ("raw_ratings",), f"""
  SELECT *, {ts_of_text('date')} AS rated_at, CAST(CAST({ts_of_text('date')} AS DATE) AS TIMESTAMP) AS day_ts,
         {app_key('package', day_of_ts_text('date'), 'app_version_name')} AS app_k
  FROM raw_ratings""")

cte("keyed_installs", ("raw_installs",), f"""
  SELECT *, CAST(CAST(date AS DATE) AS TIMESTAMP) AS day_ts,
         {app_key('package', day_of_date('date'), 'version')} AS app_k,
         {camp_key(day_of_date('date'), 'campaign', 'country')} AS camp_k
  FROM raw_installs""")

cte("keyed_trials", ("raw_trials",), f"""
  SELECT *, CAST(CAST({ts_of_text('installTimestamp')} AS DATE) AS TIMESTAMP) AS day_ts,
         {app_key('package', day_of_ts_text('installTimestamp'), 'version')} AS app_k
  FROM raw_trials""")

cte("keyed_spend", ("raw_spend",), f"""
  SELECT *, CAST(CAST(date AS DATE) AS TIMESTAMP) AS day_ts,
         {camp_key(day_of_date('date'), 'campaign', 'country')} AS camp_k
  FROM raw_spend""")

cte("app_dim", ("keyed_engagement", "keyed_ratings", "keyed_installs", "keyed_trials"), f"""
  SELECT app_k AS hash_key, package, day_ts AS date, version, {ETL} AS etl_timestamp
  FROM (SELECT app_k, package, day_ts, version FROM keyed_installs
        UNION ALL SELECT app_k, package, day_ts, version FROM keyed_trials
        UNION ALL SELECT app_k, package, day_ts, app_version_name FROM keyed_ratings
        UNION ALL SELECT app_k, package, day_ts, version FROM keyed_engagement) seen
  GROUP BY app_k, package, day_ts, version""")

cte("camp_dim", ("keyed_installs", "keyed_spend"), f"""
  SELECT camp_k AS hash_key, day_ts AS date, campaign, country, {ETL} AS etl_timestamp
  FROM (SELECT camp_k, day_ts, campaign, country FROM keyed_spend
        UNION ALL SELECT camp_k, day_ts, campaign, country FROM keyed_installs) seen
  GROUP BY camp_k, day_ts, campaign, country""")

cte("f_engagement", ("keyed_engagement", "app_dim"), f"""
  SELECT app_k AS hash_key, country_code, sessions, avg_session_duration, dau, wau, mau, {ETL} AS etl_timestamp
  FROM keyed_engagement WHERE app_k IN (SELECT hash_key FROM app_dim) GROUP BY ALL""")

cte("f_rating", ("keyed_ratings", "app_dim"), f"""
  SELECT app_k AS hash_key, rated_at AS date, app_version_code, star_rating, {ETL} AS etl_timestamp
  FROM keyed_ratings WHERE app_k IN (SELECT hash_key FROM app_dim) GROUP BY ALL""")

cte("f_installs", ("keyed_installs", "app_dim", "camp_dim"), f"""
  SELECT app_k AS hash_key, user_id, mobile_brand_name, mobile_marketing_name,
         camp_k AS hash_date_campaign_country, source, {ETL} AS etl_timestamp
  FROM keyed_installs
  WHERE app_k IN (SELECT hash_key FROM app_dim) AND camp_k IN (SELECT hash_key FROM camp_dim)
  GROUP BY ALL""")

cte("f_trials", ("keyed_trials", "app_dim"), f"""
  SELECT app_k AS hash_key, userID AS user_id, sku, orderID AS order_id,
         {ts_of_text('installTimestamp')} AS install_timestamp,
         {ts_ms_of_text('purchaseTimestamp')} AS purchase_timestamp, {ETL} AS etl_timestamp
  FROM keyed_trials WHERE app_k IN (SELECT hash_key FROM app_dim) GROUP BY ALL""")

cte("f_spend", ("keyed_spend", "camp_dim"), f"""
  SELECT camp_k AS hash_key, costILS AS cost_ils, {ETL} AS etl_timestamp
  FROM keyed_spend WHERE camp_k IN (SELECT hash_key FROM camp_dim) GROUP BY ALL""")

# Keys are MD5 values and never NULL, so the mart is one set per key combined with another:
# who installed and subscribed, times which stars met which engagement rows. The COALESCE
# condition as stated is checked by join_coalesced_key and join_coalesce_fallback.
cte("subscribers", ("f_installs", "f_trials"), """
  SELECT hash_key, user_id, hash_date_campaign_country, order_id
  FROM f_installs JOIN f_trials USING (hash_key, user_id) GROUP BY ALL""")

cte("stars", ("f_rating",), """
  SELECT hash_key, star_rating FROM f_rating GROUP BY ALL""")

cte("rated_days", ("stars", "f_engagement"), """
  SELECT hash_key, star_rating, country_code, sessions, avg_session_duration, dau, wau, mau
  FROM f_engagement JOIN stars USING (hash_key)""")

cte("m_merged", ("subscribers", "rated_days"), f"""
  SELECT hash_key, user_id, hash_date_campaign_country, order_id, star_rating, country_code, sessions,
         avg_session_duration, dau, wau, mau, {ETL} AS etl_timestamp
  FROM rated_days JOIN subscribers USING (hash_key) GROUP BY ALL""")

MEASURES = {"avg_session_duration": "avg_session_duration_by_country", "sessions": "avg_session_by_country",
            "dau": "avg_dau_by_country", "wau": "avg_wau_by_country", "mau": "avg_mau_by_country"}

cte("m_avg", ("f_engagement", "raw_countries"), "\n  SELECT named.country, " + ", ".join(
    f"{round2(f'ifnull(avg({measure}), 0)')} AS {out}" for measure, out in MEASURES.items()) + f""",
         {ETL} AS etl_timestamp
  FROM f_engagement LEFT JOIN raw_countries named USING (country_code) GROUP BY named.country""")

cte("install_orders", ("f_installs", "f_trials"), """
  SELECT i.hash_key AS install_key, t.hash_key AS trial_key, i.user_id, t.order_id
  FROM f_installs i JOIN (SELECT hash_key, user_id, order_id FROM f_trials GROUP BY ALL) t
    ON t.user_id = i.user_id AND t.hash_key = i.hash_key""")


def with_ctes(*needed: str) -> str:
    """``WITH`` clause holding ``needed`` and everything they depend on, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in needed:
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name][1]}\n)" for name in order) + "\n"


RAW_CTE = {
    "app_ratings": "raw_ratings",
    "config_history": "raw_config",
    "country_code_to_name": "raw_countries",
    "country_names_to_code": "raw_countries",
    "package_engagement_metrics": "raw_engagement",
    "ua_campaign_spendings": "raw_spend",
    "user_installs": "raw_installs",
    "user_subscription_trials": "raw_trials",
}

# --- Fixed values: columns of the raw tables, and those that hold numbers.
RAW_COLUMNS = {
    "app_ratings": "package_name app_version_code app_version_name star_rating date package",
    "config_history": "package param_name version created_by created_at published_at type config_values",
    "country_code_to_name": "country country_code country_code_3",
    "country_names_to_code": "country country_code country_code_3",
    "package_engagement_metrics": "package date country_code version sessions avg_session_duration dau wau mau",
    "ua_campaign_spendings": "date campaign country costILS",
    "user_installs": "package user_id firebase_partition mobile_brand_name mobile_marketing_name version country "
                     "campaign source date",
    "user_subscription_trials": "installTimestamp purchaseTimestamp packageName userID sku orderID purchaseToken "
                                "fcmToken version package",
}
NUMBERS = {
    "app_ratings": ("app_version_code", "star_rating"),
    "config_history": ("version",),
    "package_engagement_metrics": ("sessions", "avg_session_duration", "dau", "wau", "mau"),
    "ua_campaign_spendings": ("costILS",),
    "user_subscription_trials": ("fcmToken",),
}

MART_CTE = {
    "app_user_mapping_hash_key": "app_dim",
    "date_campaign_country_mapping_hash_key": "camp_dim",
    "app_engagement_metrics": "f_engagement",
    "app_rating": "f_rating",
    "user_installs": "f_installs",
    "user_subscription_trials": "f_trials",
    "ua_campaign_spendings": "f_spend",
    "merged_app_users": "m_merged",
    "avg_session_by_country": "m_avg",
}


def _stats_union(tables: dict[str, str], extra_cols: str, stamped: bool) -> str:
    """One row per table: its row count and exact distinct-row count."""
    parts = []
    for table, source in tables.items():
        src = f"(SELECT *, {ETL} AS etl_timestamp FROM {source})" if stamped else source
        parts.append(
            f"SELECT '{table}' AS table_name{extra_cols}, "
            f"(SELECT CAST(count(*) AS BIGINT) FROM {src} s) AS row_loaded_to_bq, "
            f"(SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM {src} s) d) "
            f"AS distinct_row_loaded_to_bq")
    return "\nUNION ALL\n".join(parts)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}

    q["csv_roundtrip"] = with_ctes("raw_installs") + "SELECT * FROM raw_installs"
    q["etl_stamp"] = with_ctes("raw_spend") + f"SELECT *, {ETL} AS etl_timestamp FROM raw_spend"
    q["pipeline_table_counts"] = (
        with_ctes(*RAW_CTE.values(), *MART_CTE.values())
        + "SELECT 'data' AS layer, table_name, etl_timestamp, row_loaded_to_bq, distinct_row_loaded_to_bq FROM (\n"
        + _stats_union(RAW_CTE, f", {ETL} AS etl_timestamp", stamped=True)
        + "\n) r UNION ALL\nSELECT 'analytics' AS layer, table_name, etl_timestamp, row_loaded_to_bq, "
        + "distinct_row_loaded_to_bq FROM (\n"
        + _stats_union(MART_CTE, f", {ETL} AS etl_timestamp", stamped=False) + "\n) m")

    keys = [("PRIMARY KEY", t, "hash_key", None) for t in ("app_user_mapping_hash_key",
                                                          "date_campaign_country_mapping_hash_key")]
    keys += [("FOREIGN KEY", t, c, r) for t, c, r in [
        ("app_engagement_metrics", "hash_key", "app_user_mapping_hash_key"),
        ("app_rating", "hash_key", "app_user_mapping_hash_key"),
        ("user_subscription_trials", "hash_key", "app_user_mapping_hash_key"),
        ("user_installs", "hash_key", "app_user_mapping_hash_key"),
        ("user_installs", "hash_date_campaign_country", "date_campaign_country_mapping_hash_key"),
        ("ua_campaign_spendings", "hash_key", "date_campaign_country_mapping_hash_key"),
        ("merged_app_users", "hash_key", "app_user_mapping_hash_key"),
        ("merged_app_users", "hash_date_campaign_country", "date_campaign_country_mapping_hash_key")]]
    q["pipeline_key_checks"] = with_ctes(*MART_CTE.values()) + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{kind}' AS constraint_type, '{c}' AS column_name, "
        f"{f"'{r}'" if r else 'CAST(NULL AS VARCHAR)'} AS reference_table, {DAG} AS dag_execution_date, "
        f"{ETL} AS etl_timestamp, CAST((SELECT count(*) FROM "
        + (f"{MART_CTE[t]} WHERE {c} NOT IN (SELECT hash_key FROM {MART_CTE[r]})" if r else
           f"(SELECT {c} FROM {MART_CTE[t]} GROUP BY {c} HAVING count(*) > 1)")
        + ") AS BIGINT) AS violations" for kind, t, c, r in keys)

    q["run_timestamp"] = with_ctes(*RAW_CTE.values(), *MART_CTE.values()) + "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
        f"CAST(least(count(*), 1) AS BIGINT) AS n_timestamps, true AS one_of_run, true AS taken_in_run FROM {c}"
        for layer, tables in (("data", RAW_CTE), ("analytics", MART_CTE)) for t, c in tables.items())

    def profile(table: str, source: str, column: str) -> str:
        text = column not in NUMBERS.get(table, ())
        value = f"CASE WHEN length({column}) % 5 = 0 THEN '' ELSE {column} END" if text else column
        ends = "min(v) AS least, max(v) AS greatest" if text else (
            "CAST(NULL AS VARCHAR) AS least, CAST(NULL AS VARCHAR) AS greatest")
        empty = "v = ''" if text else "false"
        return (f"SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, '{column}' AS column_name, "
                f"CAST(count(*) FILTER (v IS NULL) AS BIGINT) AS nulls, CAST(count(*) FILTER ({empty}) AS BIGINT) AS empties, "
                f"CAST(count(DISTINCT v) AS BIGINT) AS kinds, {ends} FROM (SELECT {value} AS v FROM {source})")

    q["csv_roundtrip_all"] = with_ctes(*RAW_CTE.values()) + "\nUNION ALL\n".join(
        profile(t, source, c) for t, source in RAW_CTE.items() for c in RAW_COLUMNS[t].split())

    q["join_coalesce_fallback_nulls"] = with_ctes("install_orders", "keyed_engagement") + """
SELECT o.install_key AS hash_key, e.e_hash_key, o.user_id, o.order_id, e.country_code, e.sessions
FROM install_orders o, (SELECT CASE WHEN version IS NOT NULL THEN app_k END AS e_hash_key, country_code, sessions
                        FROM keyed_engagement) e
WHERE o.install_key = COALESCE(e.e_hash_key, o.install_key, o.trial_key)"""

    q["project_rename"] = with_ctes("raw_trials") + (
        "SELECT userID AS user_id, orderID AS order_id, sku, version FROM raw_trials")

    q["join_key_lookup"] = with_ctes("keyed_engagement", "app_dim") + """
SELECT app_k AS hash_key, country_code, sessions, d.package AS dim_package, d.version AS dim_version
FROM keyed_engagement k JOIN app_dim d ON d.hash_key = k.app_k"""

    q["join_key_semi"] = with_ctes("keyed_engagement", "app_dim") + """
SELECT app_k AS hash_key, country_code, sessions, avg_session_duration, dau, wau, mau
FROM keyed_engagement k WHERE EXISTS (SELECT 1 FROM app_dim d WHERE d.hash_key = k.app_k)"""

    q["join_two_dims"] = with_ctes("keyed_installs", "app_dim", "camp_dim") + """
SELECT app_k AS hash_key, user_id, camp_k AS hash_date_campaign_country, source
FROM keyed_installs
WHERE app_k IN (SELECT hash_key FROM app_dim) AND camp_k IN (SELECT hash_key FROM camp_dim)"""

    q["join_left_lookup"] = with_ctes("f_engagement", "raw_countries") + """
SELECT a.hash_key, a.country_code, a.sessions, b.country
FROM f_engagement a LEFT JOIN raw_countries b ON a.country_code = b.country_code"""

    q["join_composite_key"] = with_ctes("f_installs", "f_trials") + """
SELECT u.hash_key, u.user_id, u.hash_date_campaign_country, u.source, t.order_id, t.sku
FROM f_installs u JOIN f_trials t ON u.hash_key = t.hash_key AND u.user_id = t.user_id"""

    q["join_coalesced_key"] = with_ctes("install_orders", "stars") + """
SELECT r.hash_key, o.user_id, o.order_id, r.star_rating
FROM install_orders o, stars r WHERE r.hash_key = COALESCE(o.install_key, o.trial_key)"""

    q["join_coalesce_fallback"] = with_ctes("install_orders", "f_engagement") + """
SELECT o.install_key AS hash_key, o.user_id, o.order_id, e.country_code, e.sessions
FROM install_orders o, f_engagement e WHERE o.install_key = COALESCE(e.hash_key, o.install_key, o.trial_key)"""

    q["merged_app_users"] = with_ctes("m_merged") + "SELECT * FROM m_merged"

    q["distinct_rows"] = with_ctes("raw_installs") + (
        "SELECT DISTINCT package, version, country, campaign, date FROM raw_installs")

    q["group_null_key"] = with_ctes("f_engagement", "raw_countries") + """
SELECT b.country, count(*) AS row_count
FROM f_engagement a LEFT JOIN raw_countries b ON a.country_code = b.country_code
GROUP BY b.country"""

    q["distinct_row_count"] = with_ctes("raw_installs") + """
SELECT 'rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM raw_installs
UNION ALL
SELECT 'distinct_rows', CAST(count(*) AS BIGINT)
FROM (SELECT DISTINCT package, version, date FROM raw_installs)"""

    q["row_and_distinct_count"] = with_ctes(*RAW_CTE.values()) + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
        f"CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM {c})) AS BIGINT) AS distinct_row_count "
        f"FROM {c}" for t, c in RAW_CTE.items())

    q["cte_daily_trials"] = with_ctes("f_trials") + (
        "SELECT hash_key, user_id, order_id FROM f_trials GROUP BY hash_key, user_id, order_id")

    q["union_distinct_4"] = with_ctes("raw_engagement", "raw_ratings", "raw_installs", "raw_trials") + """
SELECT package, version FROM raw_engagement
UNION SELECT package, app_version_name FROM raw_ratings
UNION SELECT package, version FROM raw_installs
UNION SELECT package, version FROM raw_trials"""

    q["union_distinct_2"] = with_ctes("raw_installs", "raw_spend") + """
SELECT date, campaign, country FROM raw_installs
UNION SELECT date, campaign, country FROM raw_spend"""

    q["fn_normalize_text"] = with_ctes("raw_installs") + rf"""
SELECT DISTINCT package, campaign, lower(package) AS package_lower,
       regexp_replace(package, '[\t\n\f\r ]+', ' ', 'g') AS package_squeezed,
       trim(package) AS package_trimmed,
       {norm('package')} AS package_norm, {norm('campaign')} AS campaign_norm
FROM raw_installs"""

    q["fn_concat_null"] = with_ctes("raw_installs") + """
SELECT DISTINCT campaign, country, version,
       CASE WHEN campaign IS NULL OR country IS NULL THEN NULL ELSE campaign || country END AS strict_concat,
       coalesce(campaign, '') || coalesce(version, '') AS guarded_concat,
       coalesce(campaign, version, 'none') AS first_present
FROM raw_installs"""

    q["fn_md5_key"] = with_ctes("raw_installs") + f"""
SELECT DISTINCT package, version, md5(coalesce(version, '')) AS version_md5,
       md5({norm('package')} || coalesce(version, '')) AS package_version_md5
FROM raw_installs"""

    q["fn_parse_date"] = with_ctes("raw_spend") + f"""
SELECT DISTINCT date, CAST(date AS DATE) AS day, {day_of_date('date')} AS day_text FROM raw_spend"""

    q["fn_parse_timestamp"] = with_ctes("raw_trials") + f"""
SELECT orderID, {ts_of_text('installTimestamp')} AS install_ts,
       {ts_of_text('installTimestamp')} AS install_ts_fraction,
       {ts_ms_of_text('purchaseTimestamp')} AS purchase_ts, {ETL} AS etl_timestamp
FROM raw_trials"""

    q["fn_day_bucket"] = with_ctes("raw_ratings") + f"""
SELECT DISTINCT CAST({ts_of_text('date')} AS DATE) AS day,
       CAST(CAST({ts_of_text('date')} AS DATE) AS TIMESTAMP) AS day_start
FROM raw_ratings"""

    q["fn_round_avg"] = with_ctes("raw_engagement") + f"""
SELECT country_code, {round2('avg(avg_session_duration)')} AS avg_duration_2dp,
       {round2('avg(mau / 7)')} AS avg_mau_week_2dp
FROM raw_engagement GROUP BY country_code"""

    q["app_user_key"] = with_ctes("raw_engagement") + f"""
SELECT DISTINCT package, date, version,
       {app_key('package', day_of_date('date'), 'version')} AS hash_key
FROM raw_engagement"""

    q["campaign_key"] = with_ctes("raw_spend") + f"""
SELECT DISTINCT date, campaign, country,
       {camp_key(day_of_date('date'), 'campaign', 'country')} AS hash_key
FROM raw_spend"""

    q["app_user_key_all"] = with_ctes("keyed_engagement", "keyed_ratings", "keyed_installs", "keyed_trials") + (
        "\nUNION ALL\n".join(
            f"SELECT DISTINCT '{t}' AS source, package, {d} AS date, {v} AS version, app_k AS hash_key FROM {c}"
            for t, c, d, v in [("package_engagement_metrics", "keyed_engagement", "date", "version"),
                               ("app_ratings", "keyed_ratings", "date", "app_version_name"),
                               ("user_installs", "keyed_installs", "date", "version"),
                               ("user_subscription_trials", "keyed_trials", "installTimestamp", "version")]))

    q["campaign_key_all"] = with_ctes("keyed_installs", "keyed_spend") + "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{t}' AS source, date, campaign, country, camp_k AS hash_key FROM {c}"
        for t, c in [("user_installs", "keyed_installs"), ("ua_campaign_spendings", "keyed_spend")])

    texts = [("package", c) for c in ("raw_engagement", "raw_ratings", "raw_installs", "raw_trials", "raw_config")]
    texts += [(x, c) for x in ("campaign", "country") for c in ("raw_installs", "raw_spend")]
    q["fn_text_all"] = with_ctes(*RAW_CTE.values()) + rf"""
SELECT DISTINCT t, lower(t) AS lowered, regexp_replace(t, '[\t\n\f\r ]+', ' ', 'g') AS squeezed, trim(t) AS trimmed,
       {norm('t')} AS normalized, md5({norm('t')}) AS digest,
       CASE WHEN t IS NULL THEN NULL ELSE t || '|' || lower(t) END AS strict_concat, coalesce(t, 'none') AS present
FROM ({" UNION ALL ".join(f"SELECT {x} AS t FROM {c}" for x, c in texts)})"""

    for key, name in [("app_user_mapping", "app_dim"), ("date_campaign_country_mapping", "camp_dim"),
                      ("app_engagement_metrics", "f_engagement"), ("app_rating", "f_rating"),
                      ("user_installs", "f_installs"), ("user_subscription_trials", "f_trials"),
                      ("ua_campaign_spendings", "f_spend"), ("avg_session_by_country", "m_avg")]:
        q[key] = with_ctes(name) + f"SELECT * FROM {name}"

    q["pk_duplicates"] = with_ctes("app_dim", "camp_dim") + """
SELECT 'app_user_mapping_hash_key' AS table_name, hash_key, count(*) AS row_count
FROM app_dim GROUP BY hash_key HAVING count(*) > 1
UNION ALL
SELECT 'date_campaign_country_mapping_hash_key', hash_key, count(*)
FROM camp_dim GROUP BY hash_key HAVING count(*) > 1"""

    q["fk_orphans"] = with_ctes("f_installs", "raw_engagement") + f"""
SELECT u.hash_key, u.user_id, u.hash_date_campaign_country
FROM f_installs u
WHERE NOT EXISTS (
  SELECT 1 FROM raw_engagement a
  WHERE {app_key('a.package', day_of_date('a.date'), 'a.version')} = u.hash_key)"""

    q["table_statistics"] = with_ctes(*MART_CTE.values()) + (
        _stats_union(MART_CTE, f", {DAG} AS dag_execution_date, {ETL} AS etl_timestamp",
                     stamped=False))
    return q
