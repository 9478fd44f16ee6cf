"""Shared SQL pieces: the derived ledgers and the staged table, written for DuckDB."""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"
PERIOD = "2001-06"


def d(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"


def r(expr: str, name: str | None = None, places: int = 4) -> str:
    """Rounded half up by the same arithmetic as the shaped query."""
    return f"FLOOR(CAST({expr} AS DOUBLE) * {10**places} + 0.5::DOUBLE) / {10**places} + 0.0 AS {name or expr}"


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def exact(top: str, bottom: str, places: int, name: str) -> str:
    """Money ratio rounded half away from zero, computed in integers; 0 unless bottom > 0."""
    scale = 10**places
    t, b = f"CAST(({top}) * 100 AS HUGEINT)", f"CAST(({bottom}) * 100 AS HUGEINT)"
    units = f"SIGN({t}) * ((2 * ABS({t}) * {scale} + {b}) // (2 * {b}))"
    return f"CASE WHEN {bottom} > 0 THEN CAST({units} AS DOUBLE) / {scale} ELSE 0 END AS {name}"


def usd(amount: str, rate: str) -> str:
    """amount / rate in cents, halves away from zero, in integers."""
    top = f"2 * CAST(ABS({amount}) * 100 AS HUGEINT) * 1000000"
    rate_int = f"CAST({rate} * 1000000 AS HUGEINT)"
    cents = f"SIGN({amount}) * (({top} + {rate_int}) // (2 * {rate_int}))"
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def in_usd(amount: str, currency: str = "currency") -> str:
    whens = " ".join(
        f"WHEN {currency} = '{c}' THEN {usd(amount, f'COALESCE(usd_to_{c.lower()}, CAST(1 AS DECIMAL(10,6)))')}"
        for c in ("EUR", "GBP", "CAD", "AUD")
    )
    return f"CASE {whens} ELSE CAST({amount} AS DECIMAL(18,2)) END"


RAW = """
raw_keys AS (
  SELECT *, o_custkey % 40 AS a, o_orderkey % 12 AS m FROM orders
),
raw AS (
  SELECT sha256('o-' || CAST(o_orderkey AS VARCHAR)) AS txn_id,
    CASE a % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'brokerage' ELSE 'bank' END AS source,
    CASE a % 4 WHEN 0 THEN 'card_' WHEN 1 THEN 'brokerage_' WHEN 2 THEN 'bank_checking_'
      ELSE 'bank_savings_' END || CAST(a AS VARCHAR) AS account_id,
    o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS posted_at,
    CAST(CASE WHEN m IN (8, 9) THEN 1 ELSE -1 END * CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS amount,
    CASE a % 10 WHEN 7 THEN 'EUR' WHEN 8 THEN 'GBP' WHEN 9 THEN 'XXX' ELSE 'USD' END AS currency,
    CASE m WHEN 0 THEN 'STARBUCKS #12' WHEN 1 THEN 'AMAZON MKTPL' WHEN 2 THEN 'Shell Gas 4411'
      WHEN 3 THEN 'Corner Restaurant' WHEN 4 THEN 'NETFLIX.COM' WHEN 5 THEN 'UBER TRIP'
      WHEN 6 THEN 'ONLINE TRANSFER' WHEN 7 THEN 'DIVIDEND REINV' WHEN 8 THEN 'ACME SALARY'
      WHEN 9 THEN 'INTEREST PAID' WHEN 10 THEN 'CREDIT CARD PAYMENT'
      ELSE 'Shop ' || CAST(o_custkey AS VARCHAR) END AS merchant_raw,
    CAST(NULL AS VARCHAR) AS mcc_raw,
    'Order ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS description_raw,
    CASE WHEN m = 3 AND o_orderkey % 5 = 0 THEN 'Restaurants' END AS category_raw,
    CAST(NULL AS VARCHAR) AS counterparty_raw,
    'orders_load' AS ingest_batch_id
  FROM raw_keys
),
raw_hashed AS (
  SELECT *, md5(account_id || '_' || strftime(posted_at, '%Y-%m-%d') || '_' || CAST(amount AS VARCHAR)) AS hash_raw
  FROM raw
),
ledger AS (
  SELECT *, CAST(10000 + SUM(amount) OVER (PARTITION BY account_id ORDER BY posted_at, txn_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS balance_after
  FROM raw_hashed
)"""

FX = """
fx AS (
  SELECT day AS date,
    CAST(0.90 + dom * 0.001 AS DECIMAL(10,6)) AS usd_to_eur,
    CAST(0.75 + dom * 0.001 AS DECIMAL(10,6)) AS usd_to_gbp,
    CAST(1.30 + dom * 0.001 AS DECIMAL(10,6)) AS usd_to_cad,
    CAST(1.45 + dom * 0.001 AS DECIMAL(10,6)) AS usd_to_aud
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(day(o_orderdate) AS DECIMAL(4,0)) AS dom FROM orders)
  WHERE dom % 2 = 0
)"""

CATEGORY_ROWS = [
    ("Income", None, "Income"),
    ("Salary", "Income", "Income"),
    ("Interest", "Income", "Income"),
    ("Expenses", None, "Expenses"),
    ("Food & Dining", "Expenses", "Expenses"),
    ("Restaurants", "Expenses", "Expenses"),
    ("Transportation", "Expenses", "Expenses"),
    ("Entertainment", "Expenses", "Expenses"),
    ("Online Shopping", "Expenses", "Expenses"),
    ("Professional Services", "Expenses", "Expenses"),
    ("Transfers", "Expenses", "Transfers"),
    ("Debt Payment", "Expenses", "Debt"),
    ("Investment", "Expenses", "Investment"),
    ("Other", "Expenses", "Other"),
]


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value + "'"


CATEGORIES = (
    "\ncat(name, parent, budget_group) AS (VALUES "
    + ", ".join(f"({_text(n)}, {_text(p)}, {_text(g)})" for n, p, g in CATEGORY_ROWS)
    + ")"
)

STAGED = f"""
named AS (
  SELECT l.*,
    CASE WHEN contains(upper(merchant_raw), 'STARBUCKS') THEN 'Starbucks'
      WHEN contains(upper(merchant_raw), 'AMAZON') THEN 'Amazon'
      WHEN contains(upper(merchant_raw), 'SHELL') THEN 'Shell Gas'
      WHEN contains(upper(merchant_raw), 'NETFLIX') THEN 'Netflix'
      WHEN contains(upper(merchant_raw), 'UBER') THEN 'Uber'
      WHEN contains(upper(merchant_raw), 'CREDIT CARD') THEN 'Credit Card Payment'
      WHEN contains(upper(merchant_raw), 'TRANSFER') THEN 'Transfer'
      WHEN contains(upper(merchant_raw), 'DIVIDEND') THEN 'Dividend'
      WHEN contains(upper(merchant_raw), 'SALARY') THEN 'Salary'
      WHEN contains(upper(merchant_raw), 'INTEREST') THEN 'Interest'
      WHEN contains(upper(merchant_raw), 'PAYMENT') THEN 'Payment'
      ELSE trim(merchant_raw) END AS merchant_clean,
    CASE WHEN contains(upper(merchant_raw), 'STARBUCKS') THEN 'Food & Dining'
      WHEN contains(upper(merchant_raw), 'AMAZON') THEN 'Online Shopping'
      WHEN contains(upper(merchant_raw), 'SHELL') THEN 'Transportation'
      WHEN contains(upper(merchant_raw), 'NETFLIX') THEN 'Entertainment'
      WHEN contains(upper(merchant_raw), 'UBER') THEN 'Transportation'
      WHEN contains(upper(merchant_raw), 'CREDIT CARD') THEN 'Debt Payment'
      WHEN contains(upper(merchant_raw), 'TRANSFER') THEN 'Transfers'
      WHEN contains(upper(merchant_raw), 'DIVIDEND') THEN 'Investment'
      WHEN contains(upper(merchant_raw), 'SALARY') THEN 'Salary'
      WHEN contains(upper(merchant_raw), 'INTEREST') THEN 'Interest'
      WHEN contains(upper(merchant_raw), 'PAYMENT') THEN 'Transfers'
      WHEN contains(upper(merchant_raw), 'SHOP') THEN 'Professional Services'
      ELSE COALESCE((SELECT name FROM cat WHERE name = category_raw), 'Other') END AS category_std
  FROM ledger l
),
stg AS (
  SELECT n.*,
    CAST({in_usd('amount')} AS DECIMAL(15,2)) AS amount_usd,
    strftime(posted_at, '%Y-%m') AS month,
    CAST(posted_at AS DATE) AS day,
    cat.budget_group IN ('Transfers', 'Debt') AS is_transfer,
    cat.budget_group = 'Investment' AS is_investment,
    amount > 0 AND cat.budget_group NOT IN ('Transfers', 'Debt', 'Investment') AS is_income,
    amount < 0 AND cat.budget_group NOT IN ('Transfers', 'Debt', 'Investment') AS is_expense
  FROM named n
  LEFT JOIN fx ON CAST(n.posted_at AS DATE) = fx.date
  LEFT JOIN cat ON n.category_std = cat.name
)"""

EVENTS = """
spend AS (
  SELECT sha256('e-' || CAST(event_id AS VARCHAR)) AS txn_id,
    'user_' || CAST(user_id AS VARCHAR) AS account_id,
    ts AS posted_at,
    strftime(ts, '%Y-%m') AS month,
    CAST(-CAST(value AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS amount,
    event_type AS category_std,
    event_type || ' ' || CAST(user_id % 50 AS VARCHAR) AS merchant_clean
  FROM events
)"""


def ledger_sql(*ctes: str, select: str) -> str:
    return "WITH" + ",".join([RAW, FX, CATEGORIES, STAGED, *ctes]) + "\n" + select


def raw_sql(*ctes: str, select: str) -> str:
    return "WITH" + ",".join([RAW, *ctes]) + "\n" + select
