"""Ingest, staging, data quality, privacy, audit and metrics."""

from oracles.base import d, ledger_sql, r, raw_sql
from oracles.cashflow import BUDGET, DAILY, MONTHLY, NET_WORTH
from oracles.detection import FORECAST, LEDGER_ANOMALIES, RECUR

# --- ingest -------------------------------------------------------------------

TEXTS = """
texts AS (
  SELECT *, o_custkey % 2 = 0 AS is_credit,
    CASE o_orderkey % 7 WHEN 0 THEN '$' || format('{:,.2f}', o_totalprice)
      WHEN 1 THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
      WHEN 2 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
      WHEN 3 THEN '' WHEN 4 THEN 'n/a' WHEN 5 THEN NULL
      ELSE ' $ ' || format('{:,.2f}', o_totalprice) || ' ' END AS amount_text,
    CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
      WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      WHEN 4 THEN CASE o_orderkey % 12 WHEN 4 THEN 'not a date' ELSE strftime(o_orderdate, '%Y%m%d') END
      WHEN 5 THEN CASE o_orderkey % 12 WHEN 5 THEN strftime(o_orderdate, '%b %-d, %Y') END END AS date_text,
    CASE o_orderkey % 8 WHEN 0 THEN 'usd' WHEN 1 THEN ' US ' WHEN 2 THEN 'Dollar' WHEN 3 THEN '€' WHEN 4 THEN 'euro'
      WHEN 5 THEN 'UK' WHEN 6 THEN 'chf' END AS currency_text
  FROM orders
),
parsed AS (
  SELECT *, TRY_CAST(trim(replace(replace(amount_text, '$', ''), ',', '')) AS DECIMAL(15,2)) AS plain,
    COALESCE(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%m/%d/%Y'),
      try_strptime(date_text, '%d/%m/%Y'), try_strptime(date_text, '%Y-%m-%d %H:%M:%S'),
      try_strptime(date_text, '%b %d, %Y'), try_strptime(date_text, '%Y%m%d')) AS posted
  FROM texts
),
flipped AS (
  SELECT *, COALESCE(CASE WHEN is_credit AND plain > 0 THEN -plain ELSE plain END, 0) AS amount FROM parsed
)"""

_CHANNEL = """CASE
  WHEN regexp_matches(lower({0}), 'pos|point of sale|debit') THEN 'pos'
  WHEN regexp_matches(lower({0}), 'online|ecommerce|web') THEN 'ecom'
  WHEN regexp_matches(lower({0}), 'ach|transfer|wire') THEN 'ach'
  WHEN regexp_matches(lower({0}), 'zelle|venmo|paypal') THEN 'zelle'
  WHEN regexp_matches(lower({0}), 'atm|withdrawal') THEN 'atm'
  ELSE 'unknown' END"""

_MERCHANT = """CASE o_custkey % 5 WHEN 1 THEN 'JOE "THE" ' || CAST(o_custkey AS VARCHAR) || ', NYC'
    WHEN 2 THEN 'Merchant' || chr(10) || CAST(o_custkey AS VARCHAR) ELSE 'Merchant ' || CAST(o_custkey AS VARCHAR) END"""

EXPORTED = f"""
exported AS (
  SELECT 'Chase' AS institution, 'bank' AS source, COALESCE(posted, CASE WHEN date_text IS NULL THEN o_orderdate END) AS posted_at,
    plain AS amount, 'Shopping' AS category_raw, 'Order ' || CAST(o_orderkey AS VARCHAR) AS description,
    CAST(NULL AS DECIMAL(15,2)) AS balance_after, amount_text, date_text, o_custkey FROM parsed
  UNION ALL
  SELECT 'American Express', 'card', posted, CASE WHEN plain > 0 THEN -plain ELSE plain END, 'Travel',
    'Order ' || CAST(o_orderkey AS VARCHAR), NULL, amount_text, date_text, o_custkey FROM parsed
  UNION ALL
  SELECT 'Wells Fargo', 'bank', posted, plain, NULL, 'debit Order ' || CAST(o_orderkey AS VARCHAR),
    CAST(o_totalprice AS DECIMAL(15,2)), amount_text, date_text, o_custkey FROM parsed
  UNION ALL
  SELECT 'Bank of America', 'bank', posted, plain, NULL, 'online Order ' || CAST(o_orderkey AS VARCHAR),
    CAST(o_totalprice AS DECIMAL(15,2)), amount_text, date_text, o_custkey FROM parsed
  UNION ALL
  SELECT 'Unknown', 'bank', posted, plain, 'Order ' || CAST(o_orderkey AS VARCHAR), '', NULL, amount_text, date_text, o_custkey
  FROM parsed
),
judged AS (
  SELECT *, {_MERCHANT} AS merchant_raw,
    CASE WHEN posted_at IS NULL THEN 'unreadable date' WHEN amount IS NULL THEN 'unreadable amount'
      WHEN amount = 0 THEN 'zero amount' END AS reason
  FROM exported
)"""

_RAW_COLUMNS = (
    f"txn_id, source, account_id, posted_at, {d('amount')}, currency, merchant_raw, mcc_raw, description_raw, "
    "category_raw, counterparty_raw, ingest_batch_id, hash_raw"
)

# --- data quality ---------------------------------------------------------------


def _row(table: str, check: str, column: str, failed: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS t, '{check}' AS c, '{column}' AS col, COUNT(*) AS checked, "
        f"COUNT(CASE WHEN {failed} THEN 1 END) AS failed FROM {source}"
    )


def _unique(table: str, key: str, source: str) -> str:
    columns = key.split(",")
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"SELECT '{table}' AS t, 'unique' AS c, '{key}' AS col, COALESCE(SUM(n), 0) AS checked, "
        "COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS failed "
        f"FROM (SELECT COUNT(*) AS n FROM {source} WHERE {present} GROUP BY {key})"
    )


def _not_null(table: str, source: str, *columns: str) -> list[str]:
    return [_row(table, "not_null", c, f"{c} IS NULL", source) for c in columns]


def _range(table: str, source: str, c: str, low, high) -> str:
    return _row(table, "range", c, f"{c} < {low} OR {c} > {high}", source)


def _accepted(table: str, source: str, c: str, values: str) -> str:
    return _row(table, "accepted_values", c, f"{c} NOT IN ({values})", source)


def checks(*parts: str) -> str:
    score = "CASE WHEN checked > 0 THEN (checked - failed) / checked * 100 ELSE 0 END"
    return (
        f'SELECT t AS "table", c AS "check", col AS "column", CAST(checked AS BIGINT) AS checked, '
        f"CAST(failed AS BIGINT) AS failed, failed = 0 AS passed, {r(score, 'score')} FROM ("
        + "\nUNION ALL ".join(parts)
        + ") x"
    )


# Pattern of card numbers, limits and accepted values of the checks.
_CARD = r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b"
_RAW_NOT_NULL = _not_null(
    "raw",
    "ledger",
    "txn_id",
    "source",
    "account_id",
    "posted_at",
    "amount",
    "currency",
    "balance_after",
    "ingest_batch_id",
)
_RAW_UNIQUE = [_unique("raw", "txn_id", "ledger"), _unique("raw", "hash_raw", "ledger")]
_RAW_RANGE = [_range("raw", "ledger", "amount", -1000000, 1000000)]
_RAW_ACCEPTED = [
    _accepted("raw", "ledger", "source", "'bank', 'card', 'brokerage'"),
    _accepted("raw", "ledger", "currency", "'USD', 'EUR', 'GBP', 'CAD', 'AUD'"),
]
_RAW_REGEX = [
    _row("raw", "regex", "txn_id", "NOT regexp_matches(txn_id, '^[a-f0-9]{64}$')", "ledger"),
    _row("raw", "regex", "currency", "NOT regexp_matches(currency, '^[A-Z]{3}$')", "ledger"),
]
_RAW_ZERO = [_row("raw", "non_zero", "amount", "amount = 0", "ledger")]
_RAW_OTHER = [
    _row("raw", "date_parseable", "posted_at", "FALSE", "ledger"),
    _row("raw", "not_regex", "merchant_raw", f"regexp_matches(merchant_raw, '{_CARD}')", "ledger"),
    _row("raw", "not_regex", "description_raw", f"regexp_matches(description_raw, '{_CARD}')", "ledger"),
]
_STAGING = [
    *_not_null(
        "staging", "stg2", "txn_id", "amount_usd", "amount_ccy", "sign", "month", "merchant_clean", "category_std"
    ),
    _unique("staging", "txn_id", "stg2"),
    _range("staging", "stg2", "amount_usd", -1000000, 1000000),
    _range("staging", "stg2", "sign", -1, 1),
    _accepted("staging", "stg2", "amount_ccy", "'USD'"),
    _accepted("staging", "stg2", "sign", "1, -1, 0"),
    *[
        _accepted("staging", "stg2", c, "TRUE, FALSE")
        for c in ("is_income", "is_expense", "is_transfer", "is_investment")
    ],
    _row("staging", "regex", "month", r"NOT regexp_matches(month, '^\d{4}-\d{2}$')", "stg2"),
]
_TYPES = "'monthly', 'weekly', 'quarterly', 'yearly', 'likely_monthly', 'likely_weekly', 'irregular'"
_MARTS = [
    *_not_null("cashflow_daily", "daily", "date", "account_id", "income", "expenses", "savings_rate"),
    _unique("cashflow_daily", "date,account_id,source", "daily"),
    _range("cashflow_daily", "daily", "savings_rate", 0, 1),
    *_not_null("cashflow_monthly", "month_rates", "month", "income", "expenses", "savings_rate"),
    _unique("cashflow_monthly", "month,account_id,source", "month_rates"),
    _range("cashflow_monthly", "month_rates", "savings_rate", 0, 1),
    *_not_null("net_worth", "net", "date", "net_worth", "total_assets", "total_liabilities"),
    _unique("net_worth", "date", "net"),
    *_not_null(
        "budget_vs_actual", "budget", "month", "category_name", "budget_target", "actual_expenses", "variance"
    ),
    _unique("budget_vs_actual", "month,category_name", "budget"),
    *_not_null("recurring", "recurring", "merchant_name", "recurring_type", "confidence_score"),
    _accepted("recurring", "recurring", "recurring_type", _TYPES),
    _range("recurring", "recurring", "confidence_score", 0, 1),
    *_not_null("anomalies", "anomalies", "txn_id", "anomaly_score", "severity", "anomaly_type"),
    _unique("anomalies", "txn_id", "anomalies"),
    _range("anomalies", "anomalies", "anomaly_score", 0, 100),
    _accepted("anomalies", "anomalies", "severity", "'high', 'medium', 'low', 'minimal'"),
    *_not_null(
        "forecasts",
        "forecast",
        "forecast_date",
        "forecast_type",
        "category_name",
        "forecast_amount",
        "confidence_level",
    ),
    _accepted("forecasts", "forecast", "forecast_type", "'total', 'category'"),
    _range("forecasts", "forecast", "confidence_level", 0, 1),
]

# --- privacy ----------------------------------------------------------------------

# Patterns and tags of redaction.
_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
_PII = [
    ("credit_card", _CARD),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("email", _EMAIL),
    ("phone", r"\b\d{3}-\d{3}-\d{4}\b"),
    ("account_number", r"\b\d{8,12}\b"),
]
_LOG = [
    (_CARD, "[CARD_NUMBER]"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]"),
    (_EMAIL, "[EMAIL]"),
    (r"\b\d{3}-\d{3}-\d{4}\b", "[PHONE]"),
]


def _redact(text: str) -> str:
    for kind, pattern in _PII:
        text = f"regexp_replace({text}, '{pattern}', '[{kind.upper()}]', 'g')"
    return text


def _redact_log(text: str) -> str:
    for pattern, tag in _LOG:
        text = f"regexp_replace({text}, '{pattern}', '{tag}', 'g')"
    # word boundaries of all alphabets: mark them, match between marks, remove the marks
    mark = "chr(1)"
    text = f"{mark} || regexp_replace({text}, '([^\\pL\\pN_])', {mark} || '\\1' || {mark}, 'g') || {mark}"
    name = f"{mark} || '[A-Z][a-z]+' || {mark} || ' ' || {mark} || '[A-Z][a-z]+' || {mark}"
    return f"replace(regexp_replace({text}, {name}, '[NAME]', 'g'), {mark}, '')"


_POINTS = """COUNT(*) AS count, MIN(value) AS min, MAX(value) AS max, {avg},
  FIRST(value ORDER BY ts, {tie}) AS first, LAST(value ORDER BY ts, {tie}) AS latest"""


def _points(tie: str) -> str:
    return _POINTS.format(avg=r("AVG(value)", "avg"), tie=tie)


SQL = {
    "std_amount": "WITH" + TEXTS + f"\nSELECT o_orderkey, amount_text, is_credit, {d('amount')} FROM flipped",
    "std_date": "WITH" + TEXTS + "\nSELECT o_orderkey, date_text, posted AS posted_at FROM parsed",
    "std_currency": "WITH"
    + TEXTS
    + """
SELECT o_orderkey, CASE upper(trim(currency_text)) WHEN 'US' THEN 'USD' WHEN 'USA' THEN 'USD' WHEN 'DOLLAR' THEN 'USD'
  WHEN '$' THEN 'USD' WHEN 'EURO' THEN 'EUR' WHEN 'EU' THEN 'EUR' WHEN '€' THEN 'EUR' WHEN 'POUND' THEN 'GBP'
  WHEN 'UK' THEN 'GBP' WHEN '£' THEN 'GBP' ELSE COALESCE(upper(trim(currency_text)), 'USD') END AS currency FROM texts""",
    "detect_channel": f"SELECT doc_id, {_CHANNEL.format('text')} AS channel FROM documents",
    "txn_id_hash": raw_sql(
        select="SELECT txn_id, sha256(strftime(posted_at, '%Y-%m-%dT%H:%M:%S') || CAST(amount AS VARCHAR) || "
        "merchant_raw || description_raw || source) AS made_id FROM raw"
    ),
    "row_hash": raw_sql(select="SELECT txn_id, hash_raw FROM raw_hashed"),
    "ingest_valid": "WITH"
    + TEXTS
    + f"""
SELECT CASE WHEN posted IS NULL THEN 'unreadable date' WHEN plain IS NULL THEN 'unreadable amount'
  WHEN amount = 0 THEN 'zero amount' ELSE 'valid' END AS outcome, COUNT(*) AS rows, {d('SUM(amount)', 'amount')}
FROM flipped GROUP BY 1""",
    "ingest_csv": "WITH"
    + TEXTS
    + """
SELECT date_text AS "Transaction Date", strftime(o_orderdate, '%Y-%m-%d') AS "Post Date",
  """
    + _MERCHANT
    + """ AS "Description", 'Shopping' AS "Category", 'Sale' AS "Type",
  nullif(trim(amount_text), '') AS "Amount", 'Order ' || CAST(o_orderkey AS VARCHAR) AS "Memo", CAST(NULL AS VARCHAR) AS _corrupt
FROM texts""",
    "ingest_mapped": "WITH"
    + TEXTS
    + ","
    + EXPORTED
    + f"""
SELECT sha256(strftime(posted_at, '%Y-%m-%dT%H:%M:%S') || CAST(amount AS VARCHAR) || merchant_raw || description
    || institution) AS txn_id,
  source, institution AS account_id, posted_at, {d('amount')}, 'USD' AS currency, merchant_raw,
  CAST(NULL AS VARCHAR) AS mcc_raw, description AS description_raw, category_raw,
  CAST(NULL AS VARCHAR) AS counterparty_raw, {d('balance_after')},
  md5(institution || '_' || strftime(posted_at, '%Y-%m-%d') || '_' || CAST(amount AS VARCHAR)) AS hash_raw,
  institution || '_20010802_120000' AS ingest_batch_id, institution, CAST(NULL AS VARCHAR) AS city,
  CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS country, {_CHANNEL.format('description')} AS channel
FROM judged WHERE reason IS NULL""",
    "ingest_quarantine": "WITH"
    + TEXTS
    + ","
    + EXPORTED
    + """
SELECT institution, reason AS reject_reason, COUNT(*) AS rows FROM judged WHERE reason IS NOT NULL GROUP BY 1, 2""",
    "ingest_failures": "WITH"
    + TEXTS
    + ","
    + EXPORTED
    + """,
faults(institution, reason) AS (VALUES ('Chase', 'missing file'), ('American Express', 'missing columns: amount, description'))
SELECT f.institution, f.reason, CAST(1 AS BIGINT) AS files, COUNT(*) AS loaded
FROM faults f JOIN judged j ON j.institution = f.institution AND j.reason IS NULL GROUP BY 1, 2""",
    "raw_append": raw_sql(select=f"SELECT {_RAW_COLUMNS} FROM raw_hashed"),
    "stream_ingest": raw_sql(
        select=f"SELECT {_RAW_COLUMNS}, CAST(NULL AS DOUBLE) AS balance_after FROM raw_hashed"
    ),
    "stream_quarantine": raw_sql(
        select="SELECT 'currency pattern' AS reason, COUNT(*) AS rows FROM raw_hashed WHERE txn_id < '08'"
    ),
    "incr_moved_keys": raw_sql(
        select=f"""SELECT {_RAW_COLUMNS.replace(d('amount'), "CAST(CASE WHEN txn_id < '1a' THEN amount + 1 ELSE amount END AS DOUBLE) AS amount").replace('posted_at', "CASE WHEN txn_id < '1a' THEN posted_at + INTERVAL 45 DAY ELSE posted_at END AS posted_at")}
FROM raw_hashed"""
    ),
    "incr_posted_at": raw_sql(
        select=f"""SELECT {_RAW_COLUMNS} FROM raw_hashed
WHERE posted_at > (SELECT MAX(posted_at) FROM raw WHERE posted_at < TIMESTAMP '2000-12-31')"""
    ),
    "stg_merchant": ledger_sql(select="SELECT txn_id, merchant_raw, merchant_clean, category_std FROM named"),
    "stg_merchant_table": ledger_sql(
        """
shops AS (
  SELECT merchant_raw, MIN_BY(c_custkey, (30 - length(CAST(c_custkey AS VARCHAR)), c_custkey)) AS k
  FROM (SELECT DISTINCT merchant_raw FROM ledger) JOIN customer ON contains(upper(merchant_raw), 'SHOP ' || CAST(c_custkey AS VARCHAR)) GROUP BY 1
)""",
        select="""SELECT txn_id, n.merchant_raw, CASE WHEN k IS NOT NULL THEN 'Shop of customer ' || CAST(k AS VARCHAR) ELSE merchant_clean END AS merchant_clean,
  CASE WHEN k IS NOT NULL THEN 'Professional Services' ELSE category_std END AS category_std
FROM named n LEFT JOIN shops s ON n.merchant_raw = s.merchant_raw"""
    ),
    "stg_fx": ledger_sql(
        select=f"SELECT txn_id, currency, {d('amount')}, {d('amount_usd')}, 'USD' AS amount_ccy FROM stg"
    ),
    "stg_flags": ledger_sql(
        select=f"""SELECT txn_id, CAST(SIGN(amount) AS INTEGER) AS sign, {d('ABS(amount)', 'abs_amount')},
  amount < 0 AS is_debit, month, strftime(posted_at, '%G-W%V') AS week, is_income, is_expense, is_transfer, is_investment
FROM stg"""
    ),
    "running_balance": raw_sql(
        select=f"SELECT txn_id, account_id, posted_at, {d('amount')}, {d('balance_after')} FROM ledger"
    ),
    "category_rollup": ledger_sql(
        select=f"""SELECT COALESCE(c.parent, c.name) AS root_name, p.budget_group AS root_group,
  COUNT(DISTINCT category_std) AS categories, COUNT(*) AS transactions, {d('SUM(amount_usd)', 'amount_usd')}
FROM stg s JOIN cat c ON s.category_std = c.name JOIN cat p ON p.name = COALESCE(c.parent, c.name) GROUP BY 1, 2"""
    ),
    "category_rollup_deep": f"""SELECT r_name AS root_name, 'in ' || r_name AS root_group, COUNT(DISTINCT c_custkey) AS categories, COUNT(*) AS transactions,
  {d('SUM(CAST(o_totalprice AS DECIMAL(15,2)))', 'amount_usd')}
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "account_balances": raw_sql(
        select=f"""SELECT account_id, LAST(source ORDER BY posted_at, txn_id) AS institution,
  {d('LAST(balance_after ORDER BY posted_at, txn_id)', 'current_balance')}, MAX(posted_at) AS last_updated,
  LAST(currency ORDER BY posted_at, txn_id) AS currency FROM ledger GROUP BY 1"""
    ),
    "account_balance_totals": raw_sql(
        """
latest AS (
  SELECT account_id, LAST(balance_after ORDER BY posted_at, txn_id) AS b, LAST(currency ORDER BY posted_at, txn_id) AS currency
  FROM ledger GROUP BY 1
)""",
        select=f"SELECT currency, {d('SUM(b)', 'total_balance')}, COUNT(*) AS accounts FROM latest GROUP BY 1",
    ),
    "dq_not_null": raw_sql(select=checks(*_RAW_NOT_NULL)),
    "dq_unique": raw_sql(select=checks(*_RAW_UNIQUE)),
    "dq_duplicate_rows": "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
    "dq_range": raw_sql(select=checks(*_RAW_RANGE)),
    "dq_accepted": raw_sql(select=checks(*_RAW_ACCEPTED)),
    "dq_regex": raw_sql(select=checks(*_RAW_REGEX)),
    "dq_zero": raw_sql(select=checks(*_RAW_ZERO)),
    "dq_no_pii": checks(_row("documents", "not_regex", "text", f"regexp_matches(text, '{_CARD}')", "documents")),
    "dq_row_count": checks(
        *[
            f"SELECT '{t}' AS t, 'row_count' AS c, '*' AS col, COUNT(*) AS checked, "
            f"CASE WHEN COUNT(*) BETWEEN 1 AND 10000000 THEN 0 ELSE 1 END AS failed FROM {t}"
            for t in ("orders", "customer", "lineitem", "events")
        ]
    ),
    "dq_contract": """SELECT reason, COUNT(*) AS rows FROM (
  SELECT 'source not accepted' AS reason FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'currency pattern' FROM orders WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT 'account_id missing' FROM orders WHERE o_orderpriority = '3-MEDIUM') GROUP BY 1""",
    "dq_fk": checks(
        "SELECT 'orders->customer' AS t, 'foreign_key' AS c, 'o_custkey' AS col, COUNT(*) AS checked, "
        "COUNT(CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 1 END) AS failed FROM orders",
        "SELECT 'orders->customer in credit', 'foreign_key', 'o_custkey', COUNT(*), COUNT(CASE WHEN o_custkey NOT IN "
        "(SELECT c_custkey FROM customer WHERE c_acctbal >= 0) THEN 1 END) FROM orders",
    ),
    "dq_keys": ledger_sql(
        BUDGET,
        LEDGER_ANOMALIES,
        FORECAST,
        select=checks(
            # the seed has 30 rows, all with known parents
            "SELECT 'categories' AS t, 'foreign_key' AS c, 'parent' AS col, 30 AS checked, 0 AS failed",
            "SELECT 'budget', 'foreign_key', 'category_name', COUNT(*), COUNT(CASE WHEN category_name NOT IN "
            "(SELECT name FROM cat) THEN 1 END) FROM budget",
            "SELECT 'anomalies', 'foreign_key', 'txn_id', COUNT(*), COUNT(CASE WHEN txn_id NOT IN (SELECT txn_id FROM raw) "
            "THEN 1 END) FROM anomalies",
            "SELECT 'forecasts', 'foreign_key', 'category_name', COUNT(*), COUNT(CASE WHEN category_name NOT IN "
            "(SELECT name FROM cat) THEN 1 END) FROM forecast",
        ),
    ),
    "dq_schema": raw_sql(
        select=checks(
            *[
                f"SELECT 'raw' AS t, '{c}' AS c, '{col}' AS col, CAST(1 AS BIGINT) AS checked, {failed} AS failed"
                for c, col, failed in (
                    ("type", "txn_id", 0),
                    ("type", "amount", 1),
                    ("type_list", "amount", 0),
                    ("type_list", "posted_at", 0),
                    ("columns_ordered", "*", 1),
                    ("columns_superset", "*", 0),
                )
            ],
            "SELECT 'raw', 'row_count', '*', COUNT(*), CASE WHEN COUNT(*) BETWEEN 1 AND 10000000 THEN 0 ELSE 1 END FROM raw",
        )
    ),
    "dq_balance": raw_sql(
        """
marked AS (
  SELECT txn_id, account_id, posted_at, amount,
    CAST(balance_after + CASE WHEN description_raw LIKE '%1-URGENT' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS balance_after
  FROM ledger
),
stepped AS (
  SELECT *, LAG(balance_after) OVER (PARTITION BY account_id ORDER BY posted_at, txn_id) AS previous_balance FROM marked
)""",
        select=f"""SELECT txn_id, account_id, posted_at, {d('amount')}, {d('previous_balance')}, {d('balance_after')}
FROM stepped WHERE balance_after - previous_balance <> amount""",
    ),
    "dq_report": ledger_sql(
        "\nstg2 AS (SELECT *, 'USD' AS amount_ccy, CAST(SIGN(amount) AS INTEGER) AS sign FROM stg)",
        DAILY,
        MONTHLY,
        NET_WORTH,
        BUDGET,
        LEDGER_ANOMALIES,
        FORECAST,
        RECUR,
        select=checks(
            *_RAW_NOT_NULL,
            *_RAW_UNIQUE,
            *_RAW_RANGE,
            *_RAW_ACCEPTED,
            *_RAW_REGEX,
            *_RAW_OTHER,
            *_RAW_ZERO,
            *_STAGING,
            *_MARTS,
        ),
    ),
    "pii_redact": f"SELECT doc_id, {_redact('text')} AS text FROM documents",
    "pii_redact_names": f"SELECT conv_id, turn, {_redact_log('text')} AS text FROM conversations",
    "pii_scan": "SELECT lang, COUNT(*) AS rows, "
    + ", ".join(f"COUNT(CASE WHEN regexp_matches(text, '{p}') THEN 1 END) AS {k}" for k, p in _PII)
    + " FROM documents GROUP BY 1",
    "pii_redact_map": f"""SELECT doc_id, {_redact('text')} AS text, {_redact('source')} AS source,
  array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_redact('x')}), chr(10)) AS lines FROM documents""",
    "hash_merchant": raw_sql(
        select="""SELECT txn_id, left(sha256(merchant_raw || 'finops_salt_2024'), 16) AS merchant_hash,
  left(sha256(merchant_raw || 'finops_salt'), 16) AS ingest_merchant_hash,
  left(sha256(account_id || 'finops_salt_2024'), 12) AS account_hash FROM raw"""
    ),
    "audit_hash": raw_sql(
        select="""SELECT txn_id, sha256('{"account_id":"' || account_id || '","amount":' || CAST(amount AS VARCHAR)
  || ',"currency":"' || currency || '","txn_id":"' || txn_id || '"}') AS audit_hash FROM raw"""
    ),
    "audit_trail": """SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS action, COUNT(*) AS events,
  COUNT(CASE WHEN event_type <> 'error' THEN 1 END) AS succeeded, COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS failed,
  MAX(ts) AS last_seen FROM events GROUP BY 1, 2""",
    "load_metrics": "\nUNION ALL ".join(
        f"""SELECT name, '{t}' AS table_name, unit, CASE WHEN unit = 'rows' THEN CAST((SELECT COUNT(*) FROM {t}) AS DOUBLE) END AS rows, TRUE AS positive
FROM (VALUES ('data_processing_rows', 'rows'), ('data_processing_duration_ms', 'ms'), ('data_processing_throughput', 'rows/sec')) v(name, unit)"""
        for t in ("orders", "events", "customer")
    ),
    "metric_summary": f"SELECT event_type AS name, {_points('event_id')} FROM events GROUP BY 1",
    "stream_metrics_daily": f"""SELECT date_trunc('day', ts) AS window_start,
  date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type AS name, {_points('value')} FROM events GROUP BY 1, 2, 3""",
    "metric_windows": f"""SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  event_type AS name, {_points('value')} FROM events GROUP BY 1, 2, 3""",
}

SQL["dq_summary"] = f"""SELECT "table", COUNT(CASE WHEN passed THEN 1 END) AS checks_passed, COUNT(*) AS total_checks,
  {r('AVG(score)', 'quality_score')} FROM ({SQL['dq_report']}) GROUP BY 1"""
