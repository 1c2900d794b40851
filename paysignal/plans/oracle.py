"""Reference SQL (DuckDB dialect) for every registered query.

The SQL re-states each query's meaning with plain window functions and
aggregates over the driver's tables (views ``events``, ``customer``...), with
no slicing, salting or other execution tricks, so agreement with the Spark
plans checks those tricks too. Money is summed as DECIMAL(18,2); mean
scores use the same half-up integer rounding as ``functions.round_ratio``.
"""

from __future__ import annotations

from paysignal.config import (
    AMOUNT_MAX,
    AMOUNT_MIN,
    CONFIG_A,
    IP_SHAPE,
    LENIENT_RULES,
    LENIENT_VPA,
    RULE_LABELS,
    RULE_NAMES,
    STRICT_RULES,
    STRICT_VPA,
    RuleConfig,
)
from paysignal.schema import REQUIRED_COLUMNS
from paysignal.sources.tables import DIRTY_AS_OF

TX = """
tx AS (
  SELECT 'TXN-' || event_id AS transaction_id,
         'UTR-' || event_id AS utr_number,
         CAST(user_id AS VARCHAR) AS user_id,
         CAST(ts AS TIMESTAMP) AS "timestamp",
         CAST(value AS DOUBLE) AS amount,
         'user' || user_id || '@bank' AS sender_vpa,
         'm' || (event_id % 30) || '@bank' AS receiver_vpa,
         event_type AS merchant_category,
         'CITY' || (k % 12) AS location_city,
         'dev-' || (user_id // 4) || '-' || (k % 5) AS device_id,
         '10.0.' || k || '.1' AS ip_address,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE WHEN event_type = 'error' THEN 'err' END AS failure_reason
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""


def ratio(num: str, den: str) -> str:
    """round(num/den, 2) half-up in integer arithmetic (num >= 0)."""
    return f"CASE WHEN ({den}) > 0 THEN CAST(((({num}) * 200 + ({den})) // (({den}) * 2)) AS DOUBLE) / 100.0 END"


def money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def cents(expr: str = "amount") -> str:
    """NaN is no money; infinite and huge amounts count as 1e15."""
    return f"CAST(CASE WHEN NOT isnan({expr}) THEN greatest(least({expr}, 1e15::DOUBLE), -1e15::DOUBLE) END AS DECIMAL(18,2))"


def scored_ctes(cfg: RuleConfig = CONFIG_A, source: str = "tx") -> str:
    """CTEs f, scored over ``source`` (needs the typed transaction columns)."""
    n = cfg.burst_failures
    lags = ", ".join(f"LAG(su, {i}) OVER w AS l{i}" for i in range(1, n + 1))
    burst_lags = " AND ".join(f"l{i} = 'FAILED'" for i in range(1, n + 1))
    weights = " + ".join(f"CASE WHEN {r} THEN {int(cfg.weights[r])} ELSE 0 END" for r in RULE_NAMES)
    reasons = ", ".join(f"CASE WHEN {r} THEN '{r}' END" for r in RULE_NAMES)
    g = cfg.geo_window_s
    return f"""
b AS (SELECT *, epoch_us("timestamp") // 1000000 AS u, upper(status) AS su FROM {source}),
f AS (
  SELECT *,
    SUM({cents()}) OVER (PARTITION BY user_id ORDER BY u RANGE BETWEEN {cfg.velocity_window_s} PRECEDING AND CURRENT ROW) AS vel,
    LAG(location_city) OVER w AS prev_city, LEAD(location_city) OVER w AS next_city,
    LAG(u) OVER w AS prev_u, LEAD(u) OVER w AS next_u,
    {lags}, LAG(u, {n}) OVER w AS lag_u,
    CAST(COUNT(DISTINCT user_id) OVER (PARTITION BY device_id ORDER BY u RANGE BETWEEN {cfg.mule_window_s} PRECEDING AND CURRENT ROW) AS INTEGER) AS dusers
  FROM b
  WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", transaction_id)
),
r AS (
  SELECT *,
    COALESCE(vel > {cfg.velocity_limit}, false) AS velocity_check,
    COALESCE((prev_city IS NOT NULL AND prev_city <> location_city AND u - prev_u <= {g})
          OR (next_city IS NOT NULL AND next_city <> location_city AND next_u - u <= {g}), false) AS geo_anomaly,
    COALESCE(dusers >= {cfg.mule_users}, false) AS device_mule_check,
    COALESCE(su = 'SUCCESS' AND {burst_lags} AND u - lag_u <= {cfg.burst_window_s}, false) AS failure_burst_check
  FROM f
),
scored AS (
  SELECT *,
    CAST("timestamp" AS DATE) AS transaction_date,
    CAST(vel AS DOUBLE) AS velocity_amount_1m,
    dusers AS device_users_10m,
    CAST(least({weights}, {int(cfg.cap)}) AS INTEGER) AS risk_score,
    concat_ws(',', {reasons}) AS fraud_reason
  FROM r
),
scored2 AS (
  SELECT *, risk_score > 0 AS is_fraud,
    CASE WHEN risk_score <= 0 THEN 'None' WHEN risk_score <= 24 THEN 'Low' WHEN risk_score <= 49 THEN 'Medium'
         WHEN risk_score <= 79 THEN 'High' ELSE 'Critical' END AS risk_level
  FROM scored
),
fraud AS (SELECT * FROM scored2 WHERE is_fraud)"""


def with_scored(body: str, cfg: RuleConfig = CONFIG_A) -> str:
    return f"WITH {TX},{scored_ctes(cfg)}\n{body}"


SCORED_COLUMNS = (
    "transaction_id, user_id, \"timestamp\", amount, merchant_category, location_city, device_id, status, "
    "transaction_date, velocity_amount_1m, device_users_10m, velocity_check, geo_anomaly, device_mule_check, "
    "failure_burst_check, risk_score, fraud_reason, is_fraud, risk_level"
)

MULES = """mules AS (
  SELECT user_id, COUNT(*) AS flagged_transaction_count, COUNT(DISTINCT device_id) AS distinct_devices,
         COUNT(DISTINCT location_city) AS distinct_cities, MAX(risk_score) AS max_risk_score,
         MIN("timestamp") AS first_flagged_timestamp, MAX("timestamp") AS last_flagged_timestamp
  FROM scored2 WHERE device_mule_check GROUP BY user_id)"""


def _positions(sql: str, order: str) -> str:
    return f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position FROM ({sql})"


def _labels_sql() -> str:
    parts = ", ".join(f"CASE WHEN {r} THEN '{RULE_LABELS[r]}' END" for r in RULE_NAMES)
    return f"concat_ws(', ', {parts})"


def scoring_queries() -> dict[str, str]:
    m = money(f"SUM({cents()})")
    q: dict[str, str] = {}
    q["score_transactions"] = with_scored(f"SELECT {SCORED_COLUMNS} FROM scored2")
    q["score_transactions_large"] = q["score_transactions"]
    q["score_transactions_dense"] = q["score_transactions"]
    q["rule_velocity"] = with_scored(
        "SELECT transaction_id, user_id, \"timestamp\", amount, velocity_amount_1m FROM scored2 WHERE velocity_check"
    )
    q["rule_geo"] = with_scored(
        "SELECT transaction_id, user_id, \"timestamp\", location_city FROM scored2 WHERE geo_anomaly"
    )
    q["rule_mule"] = with_scored(
        "SELECT transaction_id, device_id, user_id, \"timestamp\", device_users_10m FROM scored2 WHERE device_mule_check"
    )
    q["rule_burst"] = with_scored(
        "SELECT transaction_id, user_id, \"timestamp\", status FROM scored2 WHERE failure_burst_check"
    )
    q["risk_level_counts"] = with_scored(
        "SELECT risk_level, COUNT(*) AS transactions FROM scored2 GROUP BY risk_level"
    )
    cov = " UNION ALL ".join(
        f"SELECT '{r}' AS rule, COUNT(*) FILTER (WHERE {r}) AS hits, COALESCE(bool_or({r}), false) AS fired FROM scored2"
        for r in RULE_NAMES
    )
    q["rule_coverage"] = with_scored(cov)
    q["gold_fraud_transactions"] = with_scored(f"SELECT {SCORED_COLUMNS} FROM fraud")
    q["gold_mule_accounts"] = with_scored("SELECT * FROM mules").replace("fraud AS (", MULES + ",\nfraud AS (", 1)
    q["gold_merchant_kpi"] = with_scored(
        f"""SELECT transaction_date, merchant_category, COUNT(*) AS fraud_transaction_count,
  {m} AS fraud_amount, {ratio('SUM(risk_score)', 'COUNT(risk_score)')} AS avg_risk_score,
  COUNT(DISTINCT user_id) AS distinct_users
FROM fraud GROUP BY transaction_date, merchant_category"""
    )
    q["kpi_total"] = with_scored(
        f"SELECT COUNT(*) AS total_fraud_transactions, {m} AS total_fraud_amount, "
        f"{ratio('SUM(risk_score)', 'COUNT(risk_score)')} AS avg_fraud_risk FROM fraud"
    )
    q["kpi_daily"] = with_scored(
        f"SELECT transaction_date, COUNT(*) AS fraud_count, {m} AS fraud_amount FROM fraud GROUP BY transaction_date"
    )
    q["trend_date"] = _positions(q["kpi_daily"], "transaction_date")
    q["kpi_top_merchants"] = with_scored(
        f"SELECT merchant_category, COUNT(*) AS fraud_count, {m} AS fraud_amount FROM fraud "
        "GROUP BY merchant_category ORDER BY fraud_count DESC, merchant_category LIMIT 10"
    )
    mule_cols = "user_id, flagged_transaction_count, distinct_devices, distinct_cities, max_risk_score"
    q["kpi_mule_leaderboard"] = with_scored(
        f"SELECT {mule_cols} FROM mules ORDER BY flagged_transaction_count DESC, max_risk_score DESC, user_id LIMIT 20"
    ).replace("fraud AS (", MULES + ",\nfraud AS (", 1)
    q["kpi_mule_all"] = with_scored(f"SELECT {mule_cols} FROM mules").replace("fraud AS (", MULES + ",\nfraud AS (", 1)
    q["kpi_city"] = with_scored(
        f"SELECT location_city, COUNT(*) AS fraud_count, {m} AS fraud_amount FROM fraud GROUP BY location_city"
    )
    q["amount_by_city"] = _positions(q["kpi_city"], "fraud_amount DESC, location_city NULLS FIRST")
    q["kpi_city"] = _positions(q["kpi_city"], "fraud_count DESC, location_city NULLS FIRST")
    q["kpi_high_risk_users"] = with_scored(
        f"""SELECT user_id, COUNT(*) AS fraud_txn_count, {m} AS fraud_amount, MAX(risk_score) AS max_risk_score
FROM fraud GROUP BY user_id ORDER BY max_risk_score DESC, fraud_amount DESC, user_id LIMIT 10"""
    )
    q["kpi_hour"] = with_scored(
        f"SELECT CAST(hour(\"timestamp\") AS INTEGER) AS txn_hour, COUNT(*) AS fraud_count, {m} AS fraud_amount FROM fraud GROUP BY 1"
    )
    q["kpi_merchant"] = with_scored(
        f"SELECT merchant_category, COUNT(*) AS fraud_count, {m} AS fraud_amount, "
        f"{ratio('SUM(risk_score)', 'COUNT(risk_score)')} AS avg_risk_score FROM fraud GROUP BY merchant_category"
    )
    q["kpi_city_users"] = with_scored(
        f"SELECT location_city, COUNT(*) AS fraud_count, {m} AS fraud_amount, COUNT(DISTINCT user_id) AS unique_users "
        "FROM fraud GROUP BY location_city"
    )
    q["exec_kpis"] = with_scored(
        f"""SELECT COUNT(*) AS valid_transactions, COUNT(*) FILTER (WHERE is_fraud) AS flagged_transactions,
  COALESCE({ratio('COUNT(*) FILTER (WHERE is_fraud) * 100', 'COUNT(*)')}, 0.0) AS fraud_rate_pct,
  COALESCE({money(f'SUM(CASE WHEN is_fraud THEN {cents()} END)')}, 0.0) AS flagged_amount,
  COALESCE({ratio('SUM(risk_score)', 'COUNT(risk_score)')}, 0.0) AS avg_risk_score,
  COUNT(DISTINCT CASE WHEN risk_level IN ('High', 'Critical') THEN user_id END) AS high_risk_users
FROM scored2"""
    )
    q["merchant_counts"] = with_scored(
        "SELECT merchant_category, COUNT(*) AS fraud_count FROM fraud GROUP BY merchant_category"
    )
    q["risk_histogram"] = with_scored("SELECT risk_score, COUNT(*) AS transactions FROM scored2 GROUP BY risk_score")
    q["rule_hits"] = with_scored(
        " UNION ALL ".join(f"SELECT '{r}' AS rule, COUNT(*) FILTER (WHERE {r}) AS hits FROM fraud" for r in RULE_NAMES)
    )
    q["high_risk_users"] = with_scored(
        f"SELECT user_id, COUNT(transaction_id) AS fraud_count, {m} AS flagged_amount, MAX(risk_score) AS max_risk_score "
        "FROM fraud GROUP BY user_id"
    )
    q["scored_labels"] = with_scored(
        f"""SELECT transaction_id, CASE WHEN {_labels_sql()} = '' THEN 'No rule triggered' ELSE {_labels_sql()} END AS fraud_reason
FROM scored2"""
    )
    return q


# ------------------------------------------------------------------ quality

TS_FMT = "'%Y-%m-%d %H:%M:%S.%f'"

DIRTY = f"""
dirty0 AS (SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) AS eid FROM tx),
dirty1 AS (
  SELECT
    CASE WHEN eid % 101 = 1 THEN NULL ELSE transaction_id END AS transaction_id,
    CASE WHEN eid % 101 = 2 THEN NULL WHEN eid % 101 = 3 THEN 'DUP-' || (eid // 202) ELSE utr_number END AS utr_number,
    CASE WHEN eid % 101 = 9 THEN NULL ELSE user_id END AS user_id,
    strftime(CASE WHEN eid % 101 = 8 THEN "timestamp" + INTERVAL 10 YEAR ELSE "timestamp" END, {TS_FMT}) AS "timestamp",
    CASE WHEN eid % 101 = 4 THEN CAST(-amount AS VARCHAR) WHEN eid % 101 = 5 THEN '2000000.0'
      WHEN eid % 101 = 16 THEN 'NaN' WHEN eid % 101 = 17 THEN 'Infinity' WHEN eid % 101 = 18 THEN '1E20' ELSE CAST(amount AS VARCHAR) END AS amount,
    CASE WHEN eid % 101 = 6 THEN 'bad vpa' ELSE sender_vpa END AS sender_vpa,
    CASE WHEN eid % 101 = 7 THEN NULL ELSE receiver_vpa END AS receiver_vpa,
    CASE WHEN eid % 101 = 14 THEN NULL ELSE merchant_category END AS merchant_category,
    CASE WHEN eid % 101 = 15 THEN NULL ELSE location_city END AS location_city,
    CASE WHEN eid % 101 = 12 THEN NULL ELSE device_id END AS device_id,
    CASE WHEN eid % 101 = 13 THEN 'x.y' ELSE ip_address END AS ip_address,
    CASE WHEN eid % 101 = 10 THEN 'PENDING' WHEN eid % 101 = 11 THEN 'FAILED' ELSE status END AS status,
    CASE WHEN eid % 101 = 11 THEN '' ELSE failure_reason END AS failure_reason,
    eid
  FROM dirty0
),
dirty AS (SELECT * EXCLUDE (eid) FROM dirty1 UNION ALL SELECT * EXCLUDE (eid) FROM dirty1 WHERE eid % 50 = 0)"""

RAW_ORDER = (
    "transaction_id, utr_number, user_id, \"timestamp\", amount, sender_vpa, receiver_vpa, merchant_category, "
    "location_city, device_id, ip_address, status, failure_reason"
)
FIRST_ORDER = (
    '"timestamp" IS NULL, "timestamp", '
    + ", ".join(f"{c.strip()} NULLS FIRST" for c in RAW_ORDER.split(","))
)


def _strict_rules(as_of: str = DIRTY_AS_OF) -> dict[str, str]:
    return {
        "transaction_id_not_null": "transaction_id IS NOT NULL",
        "utr_not_null": "utr_number IS NOT NULL",
        "utr_unique": "utr_n = 1",
        "amount_positive": "amount > 0",
        "sender_vpa_valid": f"regexp_matches(lower(sender_vpa), '{STRICT_VPA}')",
        "receiver_vpa_valid": f"regexp_matches(lower(receiver_vpa), '{STRICT_VPA}')",
        "timestamp_not_future": f"\"timestamp\" <= TIMESTAMP '{as_of}'",
        "user_id_not_null": "user_id IS NOT NULL",
        "status_valid": "upper(status) IN ('SUCCESS', 'FAILED')",
        "failure_reason_valid": "CASE WHEN upper(status) = 'FAILED' THEN failure_reason IS NOT NULL AND length(failure_reason) > 0 ELSE true END",
        "device_id_not_null": "device_id IS NOT NULL",
        "ip_address_valid": f"regexp_matches(ip_address, '{IP_SHAPE}')",
        "merchant_category_not_null": "merchant_category IS NOT NULL",
        "location_city_not_null": "location_city IS NOT NULL",
        "amount_reasonable": f"amount BETWEEN {AMOUNT_MIN} AND {AMOUNT_MAX}",
    }


def _lenient_rules(as_of: str = DIRTY_AS_OF) -> dict[str, str]:
    def present(c):
        return f"{c} IS NOT NULL AND {c} <> ''"

    return {
        "transaction_id_not_null": present("transaction_id"),
        "utr_number_not_null": "utr_number IS NOT NULL",
        "amount_positive": "NOT isnan(amount) AND amount > 0",
        "sender_vpa_valid": f"regexp_matches(sender_vpa, '{LENIENT_VPA}')",
        "receiver_vpa_valid": f"regexp_matches(receiver_vpa, '{LENIENT_VPA}')",
        "timestamp_not_future": f"\"timestamp\" <= TIMESTAMP '{as_of}'",
        "user_id_not_null": present("user_id"),
        "status_valid": "status IN ('SUCCESS', 'FAILED')",
        "failure_reason_valid": "status <> 'FAILED' OR failure_reason <> ''",
        "device_id_not_null": present("device_id"),
        "merchant_category_not_null": present("merchant_category"),
        "location_city_not_null": present("location_city"),
        "utr_unique": "utr_n = 1",
    }


def checked_ctes(source: str, name: str, rules: dict[str, str], order: tuple) -> str:
    """CTE ``name`` = ``source`` + typed ts/amount + one column per rule,
    _is_valid and quarantine_reason."""
    flags = ",\n    ".join(f"COALESCE({rules[r]}, false) AS {r}" for r in order)
    valid = " AND ".join(order)
    reason = ", ".join(f"CASE WHEN NOT {r} THEN '{r}' END" for r in order)
    return f"""
{name}_t AS (
  SELECT * REPLACE (TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", TRY_CAST(amount AS DOUBLE) AS amount),
    COUNT(*) OVER (PARTITION BY utr_number) AS utr_n
  FROM {source}
),
{name}_f AS (SELECT *, {flags} FROM {name}_t),
{name} AS (SELECT *, {valid} AS _is_valid, concat_ws('; ', {reason}) AS quarantine_reason FROM {name}_f)"""


STANDARD = f"""
std AS (
  SELECT transaction_id, utr_number, user_id, TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
    TRY_CAST(amount AS DOUBLE) AS amount, sender_vpa, receiver_vpa, merchant_category, location_city, device_id,
    ip_address, upper(status) AS status, COALESCE(failure_reason, '') AS failure_reason,
    location_city AS payer_location, location_city AS payee_location, false AS device_change_flag,
    'Synthetic Data' AS data_origin
  FROM dirty
)"""

SILVER_SELECT = (
    "transaction_id, utr_number, user_id, \"timestamp\", amount, sender_vpa, receiver_vpa, merchant_category, "
    "location_city, device_id, ip_address, upper(status) AS status, failure_reason"
)


def _keep_first(source: str) -> str:
    """First row per transaction_id; NULL-id rows deduplicated as whole rows."""
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {FIRST_ORDER}) AS rn "
        f"FROM ({source}) s0) WHERE rn = 1 AND transaction_id IS NOT NULL "
        f"UNION ALL SELECT DISTINCT * FROM ({source}) s1 WHERE transaction_id IS NULL"
    )


def _rule_summary(source: str, order: tuple) -> str:
    parts = []
    for i, r in enumerate(order):
        parts.append(
            f"SELECT '{r}' AS rule, {i} AS rule_order, COUNT(*) FILTER (WHERE {r}) AS passed_records, "
            f"COUNT(*) FILTER (WHERE NOT {r}) AS failed_records, "
            f"COALESCE({ratio(f'COUNT(*) FILTER (WHERE {r}) * 100', 'COUNT(*)')}, 100.0) AS pass_rate_pct, "
            f"CASE WHEN COUNT(*) FILTER (WHERE NOT {r}) = 0 THEN 'PASS' ELSE 'WARNING' END AS status FROM {source}"
        )
    return " UNION ALL ".join(parts)


def quality_queries() -> dict[str, str]:
    strict = checked_ctes("dirty", "chk", _strict_rules(), STRICT_RULES)
    lenient = checked_ctes("std", "len", _lenient_rules(), LENIENT_RULES)
    head = f"WITH {TX},{DIRTY},{strict}\n"
    q: dict[str, str] = {}
    q["standardize_aliases"] = f"""WITH {TX}
SELECT transaction_id, utr_number, user_id, TRY_CAST(strftime("timestamp", {TS_FMT}) AS TIMESTAMP) AS "timestamp",
  TRY_CAST(CAST(amount AS VARCHAR) AS DOUBLE) AS amount, sender_vpa, receiver_vpa, merchant_category, location_city,
  device_id, ip_address, upper(lower(status)) AS status, '' AS failure_reason, location_city AS payer_location,
  location_city AS payee_location, false AS device_change_flag, 'Synthetic Data' AS data_origin
FROM tx"""
    wanted = {c: f"COUNT(*) FILTER (WHERE {'\"timestamp\"' if c == 'timestamp' else c} IS NULL)" for c in REQUIRED_COLUMNS}
    held = ("transaction_id", "user_id", "timestamp", "amount", "status")
    q["missing_columns"] = f"WITH {TX},{DIRTY},{STANDARD}\n" + " UNION ALL ".join(
        f"SELECT '{kind}' AS input, '{c}' AS \"column\", {str(kind == 'export' and c not in held).lower()} AS absent, "
        f"{n if kind == 'all' or c in held else 'COUNT(*)'} AS null_rows FROM std"
        for kind in ("export", "all") for c, n in wanted.items()
    )
    q["dq_flags"] = head + f"SELECT transaction_id, utr_number, {', '.join(STRICT_RULES)}, _is_valid FROM chk"
    q["dq_valid"] = head + f", v AS ({_keep_first('SELECT * FROM chk WHERE _is_valid')})\nSELECT {SILVER_SELECT} FROM v"
    q["dq_quarantine"] = head + "SELECT transaction_id, utr_number, quarantine_reason FROM chk WHERE NOT _is_valid"
    q["dq_summary"] = head + (
        "SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE _is_valid) AS valid_rows, "
        "COUNT(*) FILTER (WHERE NOT _is_valid) AS invalid_rows FROM chk"
    )
    q["dq_rule_summary"] = head + _rule_summary("chk", STRICT_RULES)
    reasons = " UNION ALL ".join(
        f"SELECT '{r}' AS rule, COUNT(*) FILTER (WHERE NOT {r}) AS failed_rows FROM chk WHERE NOT _is_valid"
        for r in STRICT_RULES
    )
    q["dq_reason_counts"] = head + f"SELECT * FROM ({reasons}) WHERE failed_rows > 0"
    q["quarantine_preview"] = head + (
        "SELECT transaction_id, quarantine_reason FROM chk WHERE NOT _is_valid "
        "ORDER BY transaction_id NULLS FIRST, utr_number NULLS FIRST, quarantine_reason LIMIT 50"
    )
    lhead = f"WITH {TX},{DIRTY},{STANDARD},{lenient}\n"
    q["dq_lenient"] = lhead + f"SELECT transaction_id, {', '.join(LENIENT_RULES)}, _is_valid, quarantine_reason FROM len"
    q["dq_lenient_summary"] = lhead + _rule_summary("len", LENIENT_RULES)
    dd = checked_ctes("dd", "chk2", _strict_rules(), STRICT_RULES)
    q["dedup_keep_first"] = (
        f"WITH {TX},{DIRTY},\ndirty_ts AS (SELECT * REPLACE (TRY_CAST(\"timestamp\" AS TIMESTAMP) AS \"timestamp\") FROM dirty),\n"
        f"dd AS ({_keep_first('SELECT * FROM dirty_ts')}),{dd}\nSELECT {SILVER_SELECT} FROM chk2 WHERE _is_valid"
    )
    q["dq_flags_large"] = q["dq_flags"]
    q["dedup_keep_first_large"] = q["dedup_keep_first"]
    q["duplicate_rows"] = f"WITH {TX},{DIRTY}\n" + (
        "SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows FROM "
        "(SELECT transaction_id, COUNT(*) AS n FROM dirty GROUP BY transaction_id HAVING COUNT(*) > 1)"
    )
    q["utr_duplicates"] = head + "SELECT transaction_id, utr_number FROM chk WHERE NOT utr_unique"
    silver_src = f"silver AS ({_keep_first('SELECT * FROM chk WHERE _is_valid')}),\nsilver2 AS (SELECT {SILVER_SELECT} FROM silver)"
    bp = " UNION ALL ".join(
        f"SELECT ((COUNT(*) FILTER (WHERE {r})) * 20000 + COUNT(*)) // (2 * COUNT(*)) AS bp FROM len" for r in LENIENT_RULES
    )
    lsilver = f"lsilver AS ({_keep_first('SELECT * FROM len WHERE _is_valid')}),\nlsilver2 AS (SELECT {SILVER_SELECT} FROM lsilver)"
    q["dashboard_layer_counts"] = (
        f"WITH {TX},{DIRTY},{STANDARD},{lenient},\n{lsilver},{scored_ctes(CONFIG_A, 'lsilver2')}\n"
        "SELECT 'bronze_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM std\n"
        "UNION ALL SELECT 'silver_rows', CAST(COUNT(*) AS DOUBLE) FROM lsilver2\n"
        "UNION ALL SELECT 'quarantine_rows', CAST(COUNT(*) AS DOUBLE) FROM len WHERE NOT _is_valid\n"
        "UNION ALL SELECT 'gold_rows', CAST(COUNT(*) AS DOUBLE) FROM fraud\n"
        f"UNION ALL SELECT 'valid_rate_pct', COALESCE({ratio('(SELECT COUNT(*) FROM lsilver2) * 100', '(SELECT COUNT(*) FROM std)')}, 100.0)\n"
        "UNION ALL SELECT 'duplicate_rows', CAST(COALESCE(SUM(n), 0) AS DOUBLE) FROM "
        "(SELECT transaction_id, COUNT(*) AS n FROM std GROUP BY transaction_id HAVING COUNT(*) > 1)\n"
        f"UNION ALL SELECT 'rule_pass_rate_pct', CAST((2 * SUM(bp) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100.0 FROM ({bp})"
    )
    states = (
        "SELECT metric, value, CASE WHEN metric IN ('quarantine_rows', 'duplicate_rows') THEN CASE WHEN value = 0 THEN 'PASS' ELSE 'WARNING' END "
        "WHEN metric = 'rule_pass_rate_pct' THEN CASE WHEN value = 100 THEN 'PASS' ELSE 'WARNING' END END AS state FROM ("
    )
    q["layer_counts"] = (
        f"WITH {TX},{DIRTY},{strict},\n{silver_src},{scored_ctes(CONFIG_A, 'silver2')}\n"
        f"{states}SELECT 'bronze_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM dirty\n"
        "UNION ALL SELECT 'silver_rows', CAST(COUNT(*) AS DOUBLE) FROM silver2\n"
        "UNION ALL SELECT 'quarantine_rows', CAST(COUNT(*) AS DOUBLE) FROM chk WHERE NOT _is_valid\n"
        "UNION ALL SELECT 'gold_rows', CAST(COUNT(*) AS DOUBLE) FROM fraud\n"
        f"UNION ALL SELECT 'valid_rate_pct', COALESCE({ratio('COUNT(*) FILTER (WHERE _is_valid) * 100', 'COUNT(*)')}, 100.0) FROM chk\n"
        "UNION ALL SELECT 'duplicate_rows', CAST(COALESCE(SUM(n), 0) AS DOUBLE) FROM "
        "(SELECT transaction_id, COUNT(*) AS n FROM dirty GROUP BY transaction_id HAVING COUNT(*) > 1)\n"
        f"UNION ALL SELECT 'rule_pass_rate_pct', COALESCE({ratio('SUM(passed_records * 100)', 'SUM(passed_records + failed_records)')}, 100.0) "
        f"FROM ({_rule_summary('chk', STRICT_RULES)}))"
    )
    return q


# ------------------------------------------------------------- scd2, alerts
DIM_COLS = (
    "user_id, name, bank, kyc_status, device_id, location_city, effective_start_date, effective_end_date, "
    "is_current, record_hash"
)


def _snapshot(city: str = "'N' || c_nationkey", name: str = "c_name", key: str = "c_custkey") -> str:
    return (
        f"SELECT CAST({key} AS VARCHAR) AS user_id, {name} AS name, c_mktsegment AS bank, "
        f"CASE WHEN {key} % 3 = 0 THEN 'FULL_KYC' WHEN {key} % 3 = 1 THEN 'MIN_KYC' ELSE 'PENDING' END AS kyc_status, "
        f"'dev-' || {key} AS device_id, {city} AS location_city"
    )


def _norm(source: str, day: str) -> str:
    return (
        f"SELECT *, DATE '{day}' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, true AS is_current, "
        "sha256(concat_ws('||', COALESCE(device_id, ''), COALESCE(location_city, ''), COALESCE(bank, ''), "
        f"COALESCE(kyc_status, ''))) AS record_hash FROM {source}"
    )


SCD2 = f"""
snap0 AS ({_snapshot()} FROM customer),
snap1 AS (
  {_snapshot("CASE WHEN c_custkey % 10 = 0 THEN 'M' || c_nationkey ELSE 'N' || c_nationkey END",
             "CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 13 = 0 THEN c_name || ' Jr' ELSE c_name END")}
  FROM customer WHERE c_custkey % 17 <> 0
  UNION ALL
  {_snapshot(key="(c_custkey + 1000000)")} FROM customer WHERE c_custkey % 25 = 0
),
dim0 AS ({_norm('snap0', '2024-01-01')}),
src1 AS ({_norm('snap1', '2024-02-01')}),
j1 AS (
  SELECT s.*, t.record_hash AS current_record_hash,
    CASE WHEN t.record_hash IS NULL THEN 'new' WHEN s.record_hash <> t.record_hash THEN 'changed' ELSE 'unchanged' END AS change
  FROM src1 s LEFT JOIN (SELECT user_id, record_hash FROM dim0 WHERE is_current) t USING (user_id)
),
dim1 AS (
  SELECT user_id, name, bank, kyc_status, device_id, location_city, effective_start_date,
    CASE WHEN is_current AND user_id IN (SELECT user_id FROM j1 WHERE change = 'changed') THEN DATE '2024-02-01' ELSE effective_end_date END AS effective_end_date,
    CASE WHEN is_current AND user_id IN (SELECT user_id FROM j1 WHERE change = 'changed') THEN false ELSE is_current END AS is_current,
    record_hash
  FROM dim0
  UNION ALL SELECT {DIM_COLS} FROM j1 WHERE change IN ('new', 'changed')
)"""

FILTER_WHERE = (
    "CAST(\"timestamp\" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' "
    "AND location_city IN ('CITY0', 'CITY1', 'CITY2', 'CITY3', 'CITY4', 'CITY5') "
    "AND merchant_category IN ('click', 'purchase', 'error') "
    "AND status IN ('SUCCESS') AND risk_level IN ('Medium', 'High', 'Critical') AND amount >= 5.0 AND amount <= 500.0 "
    "AND contains(lower(user_id), '1') AND (geo_anomaly OR device_mule_check)"
)
ALERT_COLS = (
    "transaction_id, user_id, \"timestamp\", amount, location_city, device_id, fraud_reason, risk_score, risk_level, "
    "CASE WHEN risk_score >= 80 THEN 'Escalated' WHEN risk_score >= 40 THEN 'Review' ELSE 'New' END AS investigation_status"
)
HIGH_RISK_COLS = (
    "transaction_id, user_id, \"timestamp\", amount, location_city, device_id, merchant_category, fraud_reason, "
    "risk_score, risk_level"
)


# The whole alert row as text: the transaction, the features and the investigation status.
SEARCHED = (
    *RAW_ORDER.split(", "),
    *(c for c in SCORED_COLUMNS.split(", ") if c not in RAW_ORDER.split(", ")),
    "CASE WHEN risk_score >= 80 THEN 'Escalated' WHEN risk_score >= 40 THEN 'Review' ELSE 'New' END",
)


def scd2_alert_queries() -> dict[str, str]:
    head = f"WITH {SCD2}\n"
    q: dict[str, str] = {}
    q["scd2_initial"] = head + f"SELECT {DIM_COLS} FROM dim0"
    q["scd2_changes"] = head + "SELECT user_id, record_hash, current_record_hash, change FROM j1"
    q["scd2_expire"] = head + "SELECT user_id, record_hash, effective_start_date FROM j1 WHERE change = 'changed'"
    q["scd2_insert"] = head + f"SELECT {DIM_COLS} FROM j1 WHERE change IN ('new', 'changed')"
    q["scd2_apply"] = head + f"SELECT {DIM_COLS} FROM dim1"
    q["scd2_noop"] = q["scd2_apply"]
    pit = SCD2.replace("2024-02-01", "2024-01-15").replace("2024-01-01", "2024-01-05")
    versions = ", ".join(f"v.{c} AS dim_{c}" for c in DIM_COLS.split(", ")[1:8])
    q["scd2_point_in_time"] = with_scored(
        f"""SELECT transaction_id, t.user_id, "timestamp", risk_score, {versions}
FROM scored2 t LEFT JOIN dim1 v ON t.user_id = v.user_id AND v.effective_start_date <= CAST(t."timestamp" AS DATE)
  AND (v.effective_end_date IS NULL OR CAST(t."timestamp" AS DATE) < v.effective_end_date)"""
    ).replace("fraud AS (", pit.lstrip() + ",\nfraud AS (", 1)
    q["scd2_point_in_time_large"] = q["scd2_point_in_time"]
    q["scd2_current"] = head + "SELECT COUNT(*) AS active_customer_count FROM dim1 WHERE is_current"
    q["filter_transactions"] = with_scored(f"SELECT {SCORED_COLUMNS} FROM scored2 WHERE {FILTER_WHERE}")
    q["filter_regex"] = with_scored(
        f"SELECT {SCORED_COLUMNS} FROM scored2 WHERE status = 'FAILED' AND regexp_matches(user_id, '^[13]\\d*[2-6]$|^\\D|^\\S0\\w$', 'i')"
    )
    q["filtered_kpis"] = with_scored(
        f"SELECT COUNT(*) AS filtered_transactions, COUNT(*) FILTER (WHERE is_fraud) AS fraud_transactions, "
        f"COALESCE({money(f'SUM(CASE WHEN is_fraud THEN {cents()} END)')}, 0.0) AS fraud_amount, "
        f"{ratio('SUM(risk_score)', 'COUNT(risk_score)')} AS avg_risk_score FROM scored2 WHERE {FILTER_WHERE}"
    )
    for key, order in (("alert_queue", "risk_score"), ("alert_queue_amount", "amount"), ("alert_queue_time", '"timestamp"')):
        q[key] = with_scored(f"SELECT {ALERT_COLS} FROM fraud ORDER BY {order} DESC, transaction_id LIMIT 100")
    q["alert_search"] = with_scored(
        f"SELECT {ALERT_COLS} FROM fraud WHERE contains(lower(concat_ws(' ', {', '.join(SEARCHED)})), 'utr-77')"
    )
    q["high_risk_transactions"] = with_scored(
        f"SELECT {HIGH_RISK_COLS} FROM fraud ORDER BY risk_score DESC, \"timestamp\" DESC, transaction_id LIMIT 100"
    )
    return q


# ------------------------------------------------------------ sources, sinks
RAW_SELECT = (
    "transaction_id, utr_number, user_id, strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') AS \"timestamp\", "
    "CAST(amount AS VARCHAR) AS amount, sender_vpa, receiver_vpa, merchant_category, location_city, device_id, "
    "ip_address, status, failure_reason"
)
BRONZE_SELECT = (
    "transaction_id, utr_number, user_id, TRY_CAST(\"timestamp\" AS TIMESTAMP) AS \"timestamp\", amount, sender_vpa, "
    "receiver_vpa, merchant_category, location_city, device_id, ip_address, status, NULLIF(failure_reason, '') AS failure_reason, true AS audited"
)


def _catalog_kpis() -> str:
    m = money(f"SUM({cents()})")
    top = "MAX(risk_score) AS risk FROM fraud"
    each = f"COUNT(*) AS n, {m} AS amount, {top}"
    parts = {
        "total": (f"SELECT 'all' AS name, {each}", "name", None),
        "daily": (f"SELECT CAST(transaction_date AS VARCHAR) AS name, {each} GROUP BY transaction_date", "name", None),
        "merchants": (f"SELECT merchant_category AS name, {each} GROUP BY merchant_category", "n DESC, amount DESC, name", 10),
        "cities": (f"SELECT location_city AS name, {each} GROUP BY location_city", "n DESC, amount DESC, name NULLS FIRST", None),
        "hours": (f"SELECT lpad(CAST(hour(\"timestamp\") AS VARCHAR), 2, '0') AS name, {each} GROUP BY 1", "name", None),
        "users": (f"SELECT user_id AS name, {each} GROUP BY user_id", "risk DESC, amount DESC, name", 10),
        "mules": (
            "SELECT user_id AS name, flagged_transaction_count AS n, CAST(NULL AS DOUBLE) AS amount, max_risk_score AS risk FROM mules",
            "n DESC, risk DESC, name", 20,
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{kpi}' AS kpi, CAST(position AS INTEGER) AS position, name, n, amount, risk FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({text}))" + (f" WHERE position <= {n}" if n else "")
        for kpi, (text, order, n) in parts.items()
    )


def _gold_report() -> str:
    """All marts of the scores without one day, as rows of one table."""
    m, mean = money(f"SUM({cents()})"), ratio("SUM(risk_score)", "COUNT(risk_score)")
    day, merchant, top = "transaction_date", "merchant_category", "CAST(MAX(risk_score) AS DOUBLE)"
    parts = {
        "mule_accounts": ("user_id", None, "SUM(flagged_transaction_count)", None, "CAST(MAX(max_risk_score) AS DOUBLE)", None,
                          "MAX(distinct_devices)", "MAX(distinct_cities)", "mules", "user_id"),
        "merchant_kpi": (merchant, day, "COUNT(*)", m, mean, "COUNT(DISTINCT user_id)", None, None, "fraud", f"{day}, {merchant}"),
        "total": (None, None, "COUNT(*)", m, mean, None, None, None, "fraud", None),
        "daily": (None, day, "COUNT(*)", m, None, None, None, None, "fraud", day),
        "city": ("location_city", None, "COUNT(*)", m, None, None, None, None, "fraud", "location_city"),
        "hour": ('CAST(hour("timestamp") AS VARCHAR)', None, "COUNT(*)", m, None, None, None, None, "fraud", 'hour("timestamp")'),
        "merchant": (merchant, None, "COUNT(*)", m, mean, None, None, None, "fraud", merchant),
        "city_users": ("location_city", None, "COUNT(*)", m, None, "COUNT(DISTINCT user_id)", None, None, "fraud", "location_city"),
        "users": ("user_id", None, "COUNT(*)", m, top, None, None, None, "fraud", "user_id"),
    }
    kinds = ("VARCHAR", "DATE", "BIGINT", "DOUBLE", "DOUBLE", "BIGINT", "BIGINT", "BIGINT")
    names = ("key", "day", "n", "amount", "score", "users", "devices", "cities")
    rows = " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, " + ", ".join(f"CAST({x or 'NULL'} AS {k}) AS {c}" for x, k, c in zip(values, kinds, names))
        + f" FROM {source}" + (f" GROUP BY {by}" if by else "")
        for mart, (*values, source, by) in parts.items()
    )
    ctes = scored_ctes(CONFIG_A, "left_").replace("fraud AS (", MULES + ",\nfraud AS (", 1)
    return f"WITH {TX},\nleft_ AS (SELECT * FROM tx WHERE CAST(\"timestamp\" AS DATE) <> DATE '2024-01-15'),{ctes}\n{rows}"


def io_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_stream"] = f"WITH {TX},{DIRTY}\nSELECT DISTINCT {BRONZE_SELECT} FROM dirty"
    q["scan_transactions"] = (
        f"WITH {TX}\nSELECT transaction_id, utr_number, user_id, "
        "TRY_CAST(strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') AS TIMESTAMP) AS \"timestamp\", "
        "TRY_CAST(CAST(amount AS VARCHAR) AS DOUBLE) AS amount, sender_vpa, receiver_vpa, merchant_category, "
        "location_city, device_id, ip_address, upper(status) AS status, COALESCE(failure_reason, '') AS failure_reason, "
        "CAST(TRY_CAST(strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') AS TIMESTAMP) AS DATE) AS transaction_date FROM tx"
    )
    q["stream_dedup"] = q["bronze_stream"]
    q["stream_late"] = f"WITH {TX}\n" + " UNION ALL ".join(
        f"SELECT '{name}' AS batches, transaction_id, TRY_CAST(strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') AS TIMESTAMP) "
        f"AS \"timestamp\", true AS audited, (SELECT COUNT(*) FROM tx) AS reported_rows FROM tx"
        for name in ("one", "many")
    )
    q["csv_by_name"] = f"WITH {TX}\n" + " UNION ALL ".join(
        f"SELECT '{reader}' AS reader, {RAW_SELECT} FROM tx" for reader in ("batch", "stream")
    )
    q["multi_format_read"] = f"WITH {TX}\n" + " UNION ALL ".join(
        f"SELECT '{fmt}' AS format, {RAW_SELECT} FROM tx" for fmt in ("csv", "parquet", "jsonl")
    )
    q["json_envelope"] = f"WITH {TX}\nSELECT {RAW_SELECT} FROM tx"
    q["json_large"] = f"WITH {TX}\nSELECT {RAW_SELECT}, 'say \"}}\", \\ and {{[\"' || transaction_id AS note FROM tx"
    q["csv_export"] = with_scored(f"SELECT {HIGH_RISK_COLS} FROM fraud")
    q["partitioned_write"] = with_scored(f"SELECT {SCORED_COLUMNS} FROM fraud")
    lenient = checked_ctes("std", "len", _lenient_rules(), LENIENT_RULES)
    stored = "transaction_id, user_id, amount, risk_score, risk_level FROM scored2 WHERE"
    q["precomputed_gold"] = (
        f"WITH {TX},{DIRTY},{STANDARD},{lenient},\nlsilver AS ({_keep_first('SELECT * FROM len WHERE _is_valid')}),\n"
        f"lsilver2 AS (SELECT {SILVER_SELECT} FROM lsilver),{scored_ctes(CONFIG_A, 'lsilver2')}\n"
        f"SELECT 'computed' AS branch, false AS stored_gold, {stored} is_fraud UNION ALL "
        f"SELECT 'stored', true, {stored} risk_score >= 50"
    )
    q["csv_own_headers"] = (
        f"WITH {TX},\ntx2 AS (SELECT * REPLACE (CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 3 < 2 THEN failure_reason END "
        f"AS failure_reason, CAST(amount AS VARCHAR) AS amount) FROM tx)\nSELECT {BRONZE_SELECT} FROM tx2"
    )
    q["silver_by_status"] = (
        f"WITH {TX},{DIRTY},{checked_ctes('dirty', 'chk', _strict_rules(), STRICT_RULES)},\n"
        f"v AS ({_keep_first('SELECT * FROM chk WHERE _is_valid')})\n"
        "SELECT 'silver' AS layer, upper(status) AS status, transaction_id, utr_number, '' AS quarantine_reason FROM v "
        "UNION ALL SELECT 'quarantine', upper(status), transaction_id, utr_number, quarantine_reason FROM chk WHERE NOT _is_valid"
    )
    q["clustered_write"] = with_scored("SELECT * FROM mules").replace("fraud AS (", MULES + ",\nfraud AS (", 1)
    q["catalog_tables"] = scoring_queries()["kpi_top_merchants"]
    q["catalog_kpis"] = with_scored(_catalog_kpis()).replace("fraud AS (", MULES + ",\nfraud AS (", 1)
    q["rescore_cleared"] = (
        f"WITH {TX},\nleft_ AS (SELECT * FROM tx WHERE CAST(\"timestamp\" AS DATE) <> DATE '2024-01-15'),"
        f"{scored_ctes(CONFIG_A, 'left_')}\nSELECT {SCORED_COLUMNS} FROM scored2"
    )
    q["incremental_score"] = with_scored(
        f"SELECT {SCORED_COLUMNS} FROM scored2 WHERE transaction_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"
    )
    q["scd2_versioned_write"] = scd2_alert_queries()["scd2_apply"]
    q["scd2_bucketed_write"] = q["scd2_versioned_write"]
    q["silver_incremental"] = quality_queries()["dq_flags"]
    strict = checked_ctes("dirty", "chk", _strict_rules(), STRICT_RULES)
    q["silver_stream"] = f"WITH {TX},{DIRTY},{strict}\nSELECT {SILVER_SELECT} FROM chk WHERE _is_valid"
    q["gold_incremental"] = _gold_report()
    q["bronze_bounded"] = q["bronze_stream"]
    q["zorder_write"] = q["partitioned_write"]
    q["live_scores"] = (
        f"WITH {TX},{DIRTY},{strict},\nvalid AS (SELECT {SILVER_SELECT} FROM chk WHERE _is_valid),{scored_ctes(CONFIG_A, 'valid')}\n"
        f"SELECT {SCORED_COLUMNS} FROM scored2"
    )
    # Indian grouping without look-around: reverse the leading digits, comma every two, reverse back
    grouped = (
        "CASE WHEN length(ip) <= 3 THEN ip ELSE reverse(rtrim(regexp_replace(reverse(left(ip, length(ip) - 3)), "
        "'(\\d\\d)', '\\1,', 'g'), ',')) || ',' || right(ip, 3) END || '.' || fp"
    )
    q["inr_format"] = with_scored(
        "SELECT transaction_id, amount, (CASE WHEN amount * 1000 < 0 THEN '-' ELSE '' END) || 'INR ' || "
        f"{grouped} AS amount_text FROM (SELECT transaction_id, amount, "
        "split_part(printf('%.2f', abs(amount * 1000)), '.', 1) AS ip, "
        "split_part(printf('%.2f', abs(amount * 1000)), '.', 2) AS fp FROM fraud)"
    )
    return q


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(scoring_queries())
    out.update(quality_queries())
    out.update(scd2_alert_queries())
    out.update(io_sql())
    return out
