"""Oracle SQL of the query catalogue.

Each string is an independent DuckDB query over the raw test tables
(``lineitem``, ``orders``, ``events`` registered as views). The fixture
views are re-derived in SQL here, not taken from Spark, and every rate, rule
and threshold is stated anew, so an oracle check compares two independent
computations.

Conventions shared with the Spark side: order-dependent double sums are
rounded to cents, counts are BIGINT, scores and date parts INTEGER.
"""
from __future__ import annotations

import datetime as dt

# Fixed values, stated here for themselves.
DEFAULT_RATES = {"EUR": 0.92, "GBP": 0.79, "VND": 24800.0, "JPY": 149.5, "SGD": 1.34}
VALID_CURRENCIES = ("USD", "EUR", "GBP", "VND", "JPY", "SGD")
NULL_RATE_RULES = (("amount_usd", 0.05), ("account_id", 0.0), ("transaction_type", 0.01))
CURRENCY_ISSUE_MAX_RATE = 0.02
TOLERANCE_USD = 0.01
DEFAULT_LOOKBACK_DAYS = 365
SNAPSHOT_DATE = dt.date(2001, 7, 31)
MERGE_SPLIT = dt.date(1999, 1, 1)
SOT_YEAR, SOT_MONTH = 1998, 3
GHOST_ACCOUNTS = ("ghost0", "ghost1", "ghost2")

RAW_COLS = (
    "transaction_id, account_id, amount, currency, transaction_type, status, "
    "created_at, updated_at, metadata"
)
SILVER_COLS = (
    RAW_COLS + ", amount_usd, has_currency_issue, transaction_date, transaction_year, "
    "transaction_month"
)
CUSTOM_RATES = {"EUR": 0.9, "GBP": 0.8, "USD": 2.0}


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _usd_case(rates: dict[str, float]) -> str:
    branches = ["WHEN currency = 'USD' THEN amount"] + [
        f"WHEN currency = '{k}' THEN amount / CAST({v!r} AS DOUBLE)"
        for k, v in rates.items()
        if k != "USD"
    ]
    return "CASE " + " ".join(branches) + " END"


def _valid_list() -> str:
    return ", ".join(f"'{c}'" for c in VALID_CURRENCIES)


RAW_CTE = """raw_transactions AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS account_id,
         CASE WHEN l_partkey % 50 = 7 THEN NULL ELSE l_extendedprice END AS amount,
         CASE WHEN l_partkey % 100 = 3 THEN 'XXX' WHEN l_partkey % 100 = 4 THEN NULL
              WHEN l_suppkey % 6 = 0 THEN 'USD' WHEN l_suppkey % 6 = 1 THEN 'EUR'
              WHEN l_suppkey % 6 = 2 THEN 'GBP' WHEN l_suppkey % 6 = 3 THEN 'VND'
              WHEN l_suppkey % 6 = 4 THEN 'JPY' ELSE 'SGD' END AS currency,
         CASE l_returnflag WHEN 'R' THEN 'REFUND' WHEN 'A' THEN 'TRANSFER' ELSE 'PAYMENT' END
           AS transaction_type,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED'
              WHEN 'O' THEN (CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'PENDING' END)
              ELSE 'FAILED' END AS status,
         CAST(o_orderdate AS TIMESTAMP) AS created_at,
         CAST(l_shipdate AS TIMESTAMP) AS updated_at,
         CAST(NULL AS VARCHAR) AS metadata,
         l_linenumber AS _t1, l_partkey AS _t2, l_suppkey AS _t3, l_extendedprice AS _t4
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_ORDER_LATEST = (
    "updated_at DESC NULLS LAST, _t1 DESC NULLS LAST, _t2 DESC NULLS LAST, "
    "_t3 DESC NULLS LAST, _t4 DESC NULLS LAST"
)

LATEST_CTE = f"""latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {_ORDER_LATEST}) AS rn
    FROM raw_transactions) q
  WHERE rn = 1)"""

SILVER_CTE = f"""silver AS (
  SELECT {RAW_COLS},
         {_usd_case(DEFAULT_RATES)} AS amount_usd,
         NOT (currency IN ({_valid_list()})) AS has_currency_issue,
         CAST(created_at AS DATE) AS transaction_date,
         CAST(year(created_at) AS INTEGER) AS transaction_year,
         CAST(month(created_at) AS INTEGER) AS transaction_month
  FROM latest
  WHERE status = 'COMPLETED'
    AND transaction_id IS NOT NULL AND account_id IS NOT NULL AND created_at IS NOT NULL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_SILVER = _with(RAW_CTE, LATEST_CTE, SILVER_CTE)


# ---------------------------------------------------------------- quality
def _quality_sql(absent: tuple[str, ...] = ()) -> str:
    aggs = ["count(*) AS total"]
    parts = [
        "SELECT CAST(1 AS INTEGER) AS rule_order, 'row_count' AS rule, "
        "CAST(NULL AS VARCHAR) AS column_name, "
        "CAST(CASE WHEN total = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations, "
        "CAST(total AS BIGINT) AS total_rows, CAST(total AS DOUBLE) AS metric, "
        "CAST(0.0 AS DOUBLE) AS threshold, 'error' AS severity, total > 0 AS passed FROM a"
    ]
    order = 2
    for column, max_rate in NULL_RATE_RULES:
        v = f"n{order}"
        if column in absent:
            order += 1
            continue
        aggs.append(f"count(*) FILTER (WHERE {column} IS NULL) AS {v}")
        rate = f"(CAST({v} AS DOUBLE) / CAST(total AS DOUBLE))"
        parts.append(
            f"SELECT CAST({order} AS INTEGER), 'null_rate', '{column}', CAST({v} AS BIGINT), "
            f"CAST(total AS BIGINT), {rate}, CAST({max_rate!r} AS DOUBLE), 'error', "
            f"coalesce({rate} <= CAST({max_rate!r} AS DOUBLE), false) FROM a"
        )
        order += 1
    aggs.append("count(*) FILTER (WHERE amount_usd IS NOT NULL AND amount_usd < 0) AS neg")
    parts.append(
        f"SELECT CAST({order} AS INTEGER), 'negative_amount', 'amount_usd', CAST(neg AS BIGINT), "
        f"CAST(total AS BIGINT), CAST(neg AS DOUBLE), CAST(0.0 AS DOUBLE), 'warning', neg = 0 FROM a"
    )
    order += 1
    aggs.append("count(*) FILTER (WHERE has_currency_issue) AS cur")
    rate = "(CAST(cur AS DOUBLE) / CAST(total AS DOUBLE))"
    if "has_currency_issue" not in absent:
        parts.append(
            f"SELECT CAST({order} AS INTEGER), 'currency_issue_rate', 'has_currency_issue', "
            f"CAST(cur AS BIGINT), CAST(total AS BIGINT), {rate}, "
            f"CAST({CURRENCY_ISSUE_MAX_RATE!r} AS DOUBLE), 'error', "
            f"coalesce({rate} <= CAST({CURRENCY_ISSUE_MAX_RATE!r} AS DOUBLE), false) FROM a"
        )
    a = "a AS (SELECT " + ", ".join(aggs) + " FROM silver)"
    return _with(RAW_CTE, LATEST_CTE, SILVER_CTE, a) + "\nUNION ALL\n".join(parts)


# -------------------------------------------------------------------- RFM
_SNAP = SNAPSHOT_DATE


def _rfm_base_cte(snap: dt.date) -> str:
    start = snap - dt.timedelta(days=DEFAULT_LOOKBACK_DAYS)
    return f"""base AS (
  SELECT account_id,
         CAST(date_diff('day', max(transaction_date), {_d(snap)}) AS INTEGER) AS recency_days,
         CAST(count(DISTINCT transaction_id) AS BIGINT) AS frequency,
         sum(amount_usd) AS monetary_usd
  FROM silver
  WHERE transaction_date >= {_d(start)} AND transaction_date <= {_d(snap)}
    AND amount_usd IS NOT NULL
  GROUP BY account_id)"""


RFM_BASE_CTE = _rfm_base_cte(_SNAP)


def _scored_cte(high_is_best: bool) -> str:
    tie = "account_id ASC NULLS FIRST"
    if high_is_best:
        r, f, m = "recency_days DESC NULLS LAST", "frequency ASC NULLS FIRST", "monetary_usd ASC NULLS FIRST"
    else:
        r, f, m = "recency_days ASC NULLS FIRST", "frequency DESC NULLS LAST", "monetary_usd DESC NULLS LAST"
    return f"""scored AS (
  SELECT *,
         CAST(ntile(5) OVER (ORDER BY {r}, {tie}) AS INTEGER) AS r_score,
         CAST(ntile(5) OVER (ORDER BY {f}, {tie}) AS INTEGER) AS f_score,
         CAST(ntile(5) OVER (ORDER BY {m}, {tie}) AS INTEGER) AS m_score
  FROM base)"""


_TOTAL = "(r_score + f_score + m_score)"


def _segment_case() -> str:
    return (
        f"CASE WHEN {_TOTAL} >= 13 THEN 'Champions' WHEN {_TOTAL} >= 10 THEN 'Loyal' "
        f"WHEN {_TOTAL} >= 7 AND r_score >= 3 THEN 'Potential' WHEN {_TOTAL} >= 6 AND r_score <= 2 THEN 'At Risk' "
        f"WHEN {_TOTAL} <= 5 THEN 'Lost' ELSE 'Needs Attention' END"
    )


_SCORE_COLS = (
    "account_id, recency_days, frequency, round(monetary_usd, 2) AS monetary_usd, "
    "r_score, f_score, m_score, r_score + f_score + m_score AS rfm_score"
)


def _rfm(high_is_best: bool, segments: bool, snap: dt.date = _SNAP) -> str:
    head = _with(RAW_CTE, LATEST_CTE, SILVER_CTE, _rfm_base_cte(snap), _scored_cte(high_is_best))
    cols = _SCORE_COLS
    if segments:
        cols += f", {_segment_case()} AS segment, {_d(snap)} AS snapshot_date"
    return head + f"SELECT {cols} FROM scored"


def _rfm_counts() -> str:
    head = _with(RAW_CTE, LATEST_CTE, SILVER_CTE, RFM_BASE_CTE, _scored_cte(False))
    return (
        head
        + f"SELECT segment, CAST(count(*) AS BIGINT) AS customer_count FROM "
        f"(SELECT {_segment_case()} AS segment FROM scored) s GROUP BY segment"
    )


# -------------------------------------------------------------- reconcile
_M_FIRST = dt.date(SOT_YEAR, SOT_MONTH, 1)
_M_NEXT = dt.date(SOT_YEAR + (SOT_MONTH == 12), SOT_MONTH % 12 + 1, 1)

SOT_CTE = f"""sot AS (
  SELECT account_id,
         amount_usd + CASE WHEN CAST(account_id AS BIGINT) % 10 = 0 THEN 0.02
                           WHEN CAST(account_id AS BIGINT) % 10 = 1 THEN 0.004 ELSE 0.0 END
           AS amount_usd
  FROM silver
  WHERE transaction_date >= {_d(_M_FIRST)} AND transaction_date < {_d(_M_NEXT)}
    AND CAST(account_id AS BIGINT) % 10 <> 2 AND amount_usd IS NOT NULL
  {' '.join(f"UNION ALL SELECT '{g}', CAST(10.0 AS DOUBLE)" for g in GHOST_ACCOUNTS)})"""

SILVER_MONTH_CTE = f"""sm AS (
  SELECT account_id, CAST(count(transaction_id) AS BIGINT) AS tx_count,
         sum(amount_usd) AS total_amount_usd,
         CAST(count(DISTINCT transaction_id) AS BIGINT) AS unique_tx_count,
         true AS _in_silver
  FROM silver
  WHERE transaction_date >= {_d(_M_FIRST)} AND transaction_date < {_d(_M_NEXT)}
  GROUP BY account_id)"""

SOT_MONTH_CTE = """tm AS (
  SELECT account_id, sum(amount_usd) AS sot_total_usd, true AS _in_sot
  FROM sot GROUP BY account_id)"""

JOINED_CTE = f"""j AS (
  SELECT coalesce(sm.account_id, tm.account_id) AS account_id, tx_count, total_amount_usd,
         unique_tx_count, sot_total_usd,
         abs(total_amount_usd - sot_total_usd) AS diff_usd,
         abs(total_amount_usd - sot_total_usd) > CAST({TOLERANCE_USD!r} AS DOUBLE) AS has_discrepancy,
         CASE WHEN _in_silver AND _in_sot THEN 'both' WHEN _in_silver THEN 'silver_only'
              ELSE 'sot_only' END AS match_status
  FROM sm FULL JOIN tm ON sm.account_id = tm.account_id)"""

_RECONCILE_HEAD = _with(RAW_CTE, LATEST_CTE, SILVER_CTE, SOT_CTE, SILVER_MONTH_CTE, SOT_MONTH_CTE, JOINED_CTE)


# ------------------------------------------------------------------ merge
def _merge_side(before: bool) -> str:
    name = "mt" if before else "ms"
    cond = "<" if before else ">="
    return f"""{name} AS (
  SELECT transaction_id, account_id, amount, currency, status, updated_at,
         CAST(created_at AS DATE) AS transaction_date
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {_ORDER_LATEST}) AS rn
        FROM raw_transactions WHERE updated_at {cond} {_d(MERGE_SPLIT)}) q
  WHERE rn = 1 AND status = 'COMPLETED')"""


_MERGE_HEAD = _with(RAW_CTE, _merge_side(True), _merge_side(False))
_MERGE_ROWS = (
    _MERGE_HEAD
    + "SELECT * FROM mt WHERE NOT EXISTS (SELECT 1 FROM ms WHERE ms.transaction_id = mt.transaction_id)\n"
    "UNION ALL SELECT * FROM ms"
)
_MERGE_TWO_KEYS = (
    _MERGE_HEAD
    + "SELECT * FROM mt WHERE NOT EXISTS (SELECT 1 FROM ms WHERE ms.transaction_id = mt.transaction_id AND ms.currency = mt.currency)\n"
    "UNION ALL SELECT * FROM ms"
)
_MERGE_REPEATED = (
    _MERGE_HEAD
    + """, two AS (SELECT * FROM mt UNION ALL SELECT * FROM mt)
SELECT two.* FROM two WHERE NOT EXISTS (SELECT 1 FROM ms WHERE ms.transaction_id = two.transaction_id)
UNION ALL SELECT ms.* FROM ms JOIN two ON ms.transaction_id = two.transaction_id
UNION ALL SELECT * FROM ms WHERE NOT EXISTS (SELECT 1 FROM mt WHERE ms.transaction_id = mt.transaction_id)"""
)
_MERGE_COUNTS = _MERGE_HEAD + """SELECT
  CAST((SELECT count(*) FROM mt) AS BIGINT) AS target_rows,
  CAST((SELECT count(*) FROM ms) AS BIGINT) AS source_rows,
  CAST((SELECT count(*) FROM mt WHERE EXISTS
        (SELECT 1 FROM ms WHERE ms.transaction_id = mt.transaction_id)) AS BIGINT) AS rows_updated,
  CAST((SELECT count(*) FROM ms WHERE NOT EXISTS
        (SELECT 1 FROM mt WHERE ms.transaction_id = mt.transaction_id)) AS BIGINT) AS rows_inserted,
  CAST((SELECT count(*) FROM mt) + (SELECT count(*) FROM ms WHERE NOT EXISTS
        (SELECT 1 FROM mt WHERE ms.transaction_id = mt.transaction_id)) AS BIGINT) AS result_rows"""


# ----------------------------------------------------------------- stream
_STREAM_EXPECTED = """SELECT CAST(event_id AS VARCHAR) AS event_id,
       't' || CAST(event_id % 4000 AS VARCHAR) AS transaction_id,
       CAST(user_id AS VARCHAR) AS account_id,
       value AS amount,
       upper(coalesce(CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'usd' WHEN 2 THEN 'EUR'
                           WHEN 3 THEN 'gbp' ELSE 'VND' END, 'USD')) AS currency,
       event_type,
       CAST(ts AS TIMESTAMP) AS event_time,
       CAST(ts AS DATE) AS transaction_date,
       CAST(year(ts) AS INTEGER) AS event_year,
       CAST(month(ts) AS INTEGER) AS event_month
FROM events
WHERE event_id % 97 <> 0 AND event_id % 89 <> 0"""


_RECONCILE_ROWS = (_RECONCILE_HEAD
        + "SELECT account_id, tx_count, round(total_amount_usd, 2) AS total_amount_usd, "
        "unique_tx_count, round(sot_total_usd, 2) AS sot_total_usd, round(diff_usd, 2) AS diff_usd, "
        f"has_discrepancy, match_status, '{SOT_YEAR:04d}-{SOT_MONTH:02d}' AS reconcile_month FROM j")

# The daily job's own order among versions of one time: its columns, descending.
_JOB_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "updated_at", "status", "amount", "currency", "transaction_type", "account_id", "created_at", "metadata"))
_JOB_SILVER = _with(RAW_CTE, f"""latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {_JOB_ORDER}) AS rn FROM raw_transactions) q
  WHERE rn = 1)""", SILVER_CTE)

# Rates of the dated query: the default one raised with the day of the month.
_DATED_USD = "CASE WHEN currency = 'USD' THEN amount " + " ".join(
    f"WHEN currency = '{k}' THEN amount / (CAST({v!r} AS DOUBLE) * (CAST(1.0 AS DOUBLE) + CAST(day(created_at) % 7 AS DOUBLE) / CAST(100.0 AS DOUBLE)))"
    for k, v in DEFAULT_RATES.items()) + " END"


def oracle_sql() -> dict[str, str]:
    raw = _with(RAW_CTE)
    latest = _with(RAW_CTE, LATEST_CTE)
    usd = f"SELECT {RAW_COLS}, {_usd_case(DEFAULT_RATES)} AS amount_usd FROM raw_transactions"
    return {
        "raw_transactions": raw + f"SELECT {RAW_COLS} FROM raw_transactions",
        "raw_day": raw + f"SELECT {RAW_COLS} FROM raw_transactions WHERE CAST(updated_at AS DATE) = DATE '1998-03-02'",
        "silver_stamped": BASE_SILVER + f"SELECT {SILVER_COLS}, TIMESTAMP '2024-01-01 00:00:00' AS _etl_loaded_at FROM silver",
        "silver_load": _JOB_SILVER + f"SELECT {SILVER_COLS}, TIMESTAMP '2024-01-02 00:00:00' AS _etl_loaded_at FROM silver",
        "table_scan": BASE_SILVER + f"SELECT {SILVER_COLS} FROM silver",
        "quality_report_fewer_columns": _quality_sql(("transaction_type", "has_currency_issue")),
        "segments_load": f"SELECT * FROM ({_rfm(False, True)}) UNION ALL SELECT * FROM "
        f"({_rfm(False, True, SNAPSHOT_DATE - dt.timedelta(days=30))})",
        "reconcile_load": _RECONCILE_ROWS,
        "merge_rows_two_keys": _MERGE_TWO_KEYS,
        "merge_rows_repeated_target": _MERGE_REPEATED,
        "upsert_redelivered": _MERGE_ROWS,
        "stream_replay": _STREAM_EXPECTED,
        "file_inventory": BASE_SILVER + "SELECT transaction_year, CAST(1 AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS rows, "
        "true AS not_empty FROM silver GROUP BY transaction_year",
        "raw_extract": raw + f"SELECT {RAW_COLS} FROM raw_transactions",
        "dedup_latest": latest + f"SELECT {RAW_COLS} FROM latest",
        "dedup_exact": raw + f"SELECT DISTINCT {RAW_COLS} FROM raw_transactions",
        "dedup_exact_subset": raw + "SELECT DISTINCT transaction_id, updated_at FROM raw_transactions",
        "count_duplicates": raw
        + "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_count FROM "
        "(SELECT transaction_id, count(*) AS n FROM raw_transactions GROUP BY transaction_id) g",
        "normalize_usd": raw + usd,
        "normalize_usd_custom_rates": raw
        + f"SELECT {RAW_COLS}, {_usd_case(CUSTOM_RATES)} AS amount_usd FROM raw_transactions",
        "normalize_rate_table": raw + f"SELECT {RAW_COLS}, {_DATED_USD} AS amount_usd FROM raw_transactions",
        "flag_currency_issues": raw
        + f"SELECT {RAW_COLS}, NOT (currency IN ({_valid_list()})) AS has_currency_issue "
        "FROM raw_transactions",
        "silver_transactions": BASE_SILVER + f"SELECT {SILVER_COLS} FROM silver",
        "quality_report": _quality_sql(),
        "rfm_base": _with(RAW_CTE, LATEST_CTE, SILVER_CTE, RFM_BASE_CTE)
        + "SELECT account_id, recency_days, frequency, round(monetary_usd, 2) AS monetary_usd FROM base",
        "rfm_scores": _rfm(False, False),
        "rfm_scores_distributed": _rfm(False, False),
        "rfm_segments": _rfm(False, True),
        "rfm_segments_high_is_best": _rfm(True, True),
        "rfm_segment_counts": _rfm_counts(),
        "reconcile_silver_month": _with(RAW_CTE, LATEST_CTE, SILVER_CTE, SILVER_MONTH_CTE)
        + "SELECT account_id, tx_count, round(total_amount_usd, 2) AS total_amount_usd, "
        "unique_tx_count FROM sm",
        "reconcile_compare": _RECONCILE_ROWS,
        "reconcile_summary": _RECONCILE_HEAD
        + f"SELECT CAST({SOT_YEAR} AS INTEGER) AS year, CAST({SOT_MONTH} AS INTEGER) AS month, "
        "CAST(count(*) AS BIGINT) AS accounts_checked, "
        "CAST(count(*) FILTER (WHERE has_discrepancy) AS BIGINT) AS discrepancy_count, "
        "CASE WHEN count(*) FILTER (WHERE has_discrepancy) > 0 THEN 'failed' ELSE 'passed' END "
        "AS status, CAST(NULL AS VARCHAR) AS reason FROM j",
        "merge_rows": _MERGE_ROWS,
        "merge_counts": _MERGE_COUNTS,
        "upsert_parquet": _MERGE_ROWS,
        "upsert_parquet_files": _MERGE_ROWS,
        "parse_events": _STREAM_EXPECTED,
        "stream_upsert": _STREAM_EXPECTED,
        "compact_roundtrip": BASE_SILVER + f"SELECT {SILVER_COLS} FROM silver",
    }
