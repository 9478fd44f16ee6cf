"""Ledgers derived from the given star-schema tables.

The tables hold orders, customers and events, not bank transactions. These
transforms turn every row of them into ledger rows, so the operators run over
the whole tables at any scale. All columns are plain expressions of the input.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.hashing import row_hash
from ledgermill.operators.staging import running_balance, stage
from ledgermill.reference_data import CATEGORIES, categories
from ledgermill.schemas import MONEY, RATE

LEDGER_AS_OF = date(2001, 8, 2)
EVENTS_AS_OF = date(2024, 1, 31)
RECUR_AS_OF = date(2023, 7, 1)
OPENING_BALANCE = 10000

# Rules of the derived ledger, same layout as the seed. SHOP has no merchant
# name: every shop keeps its own text. "Corner Restaurant" matches no rule.
LEDGER_RULES = [
    (1, "STARBUCKS", "Starbucks", "5814", "Food & Dining", False, 1),
    (2, "AMAZON", "Amazon", "5999", "Online Shopping", False, 1),
    (3, "SHELL", "Shell Gas", "5541", "Transportation", False, 1),
    (4, "NETFLIX", "Netflix", "7841", "Entertainment", False, 1),
    (5, "UBER", "Uber", "4121", "Transportation", False, 1),
    (6, "TRANSFER", "Transfer", "6010", "Transfers", False, 2),
    (7, "DIVIDEND", "Dividend", "6010", "Investment", False, 2),
    (8, "SALARY", "Salary", "6010", "Salary", False, 2),
    (9, "INTEREST", "Interest", "6010", "Interest", False, 2),
    (10, "CREDIT CARD", "Credit Card Payment", "6010", "Debt Payment", False, 1),
    (11, "PAYMENT", "Payment", "6010", "Transfers", False, 2),
    (12, "SHOP", None, "7300", "Professional Services", False, 3),
]

LEDGER_CATEGORIES = [*CATEGORIES, (30, 7, "Professional Services", "Expenses", False)]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ledger_categories(spark: SparkSession) -> DataFrame:
    return categories(spark, LEDGER_CATEGORIES)


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order, without running balance."""
    orders = read(spark, sf_dir, "orders")
    a = F.col("o_custkey") % 40
    m = F.col("o_orderkey") % 12
    kind = a % 4
    source = F.when(kind == 0, "card").when(kind == 1, "brokerage").otherwise("bank")
    prefix = (
        F.when(kind == 0, "card_")
        .when(kind == 1, "brokerage_")
        .when(kind == 2, "bank_checking_")
        .otherwise("bank_savings_")
    )
    merchant = (
        F.when(m == 0, "STARBUCKS #12")
        .when(m == 1, "AMAZON MKTPL")
        .when(m == 2, "Shell Gas 4411")
        .when(m == 3, "Corner Restaurant")
        .when(m == 4, "NETFLIX.COM")
        .when(m == 5, "UBER TRIP")
        .when(m == 6, "ONLINE TRANSFER")
        .when(m == 7, "DIVIDEND REINV")
        .when(m == 8, "ACME SALARY")
        .when(m == 9, "INTEREST PAID")
        .when(m == 10, "CREDIT CARD PAYMENT")
        .otherwise(F.concat(F.lit("Shop "), F.col("o_custkey").cast("string")))
    )
    minutes = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    sign = F.when(m.isin(8, 9), 1).otherwise(-1)
    rows = orders.select(
        F.sha2(F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")), 256).alias("txn_id"),
        source.alias("source"),
        F.concat(prefix, a.cast("string")).alias("account_id"),
        (F.col("o_orderdate") + minutes).alias("posted_at"),
        (sign * F.col("o_totalprice").cast(MONEY)).cast(MONEY).alias("amount"),
        F.when(a % 10 == 7, "EUR").when(a % 10 == 8, "GBP").when(a % 10 == 9, "XXX").otherwise("USD").alias("currency"),
        merchant.alias("merchant_raw"),
        F.lit(None).cast("string").alias("mcc_raw"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" "), F.col("o_orderpriority")).alias(
            "description_raw"
        ),
        F.when((m == 3) & (F.col("o_orderkey") % 5 == 0), "Restaurants").alias("category_raw"),
        F.lit(None).cast("string").alias("counterparty_raw"),
        F.lit("orders_load").alias("ingest_batch_id"),
    )
    return rows.withColumn("hash_raw", row_hash(F.col("account_id"), F.col("posted_at"), F.col("amount")))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived ledger with its running balance."""
    return running_balance(raw_ledger(spark, sf_dir), OPENING_BALANCE)


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates for the even days of month on which there are orders; odd days have none."""
    days = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    dom = F.dayofmonth("date")
    step = dom.cast("decimal(10,3)") * F.lit("0.001").cast("decimal(4,3)")
    return days.filter(dom % 2 == 0).select(
        "date",
        *[
            (F.lit(base).cast("decimal(4,2)") + step).cast(RATE).alias(f"usd_to_{code}")
            for code, base in [("eur", "0.90"), ("gbp", "0.75"), ("cad", "1.30"), ("aud", "1.45")]
        ],
    )


def staged(spark: SparkSession, sf_dir: str, with_balance: bool = False) -> DataFrame:
    """The staged ledger. The running balance needs a shuffle, so only marts that use it ask for it."""
    raw = ledger(spark, sf_dir) if with_balance else raw_ledger(spark, sf_dir)
    return stage(raw, fx_rates(spark, sf_dir), ledger_categories(spark), LEDGER_RULES)


def recurring_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six expenses per customer with a built-in cadence."""
    customer = read(spark, sf_dir, "customer")
    q = F.col("c_custkey") % 7
    step = F.when(q == 0, 7).when(q == 1, 30).when(q == 2, 90).when(q == 3, 365).when(q == 4, 30).when(q == 5, 7)
    jitter = F.when(q == 4, 10).when(q == 5, 3).otherwise(0)
    k = F.col("k")
    odd = k % 2
    days = k * step.otherwise(45) + odd * jitter
    base = (F.lit(10) + F.col("c_custkey") % 50).cast("decimal(10,2)")
    factor = F.when(q.isin(4, 5) & (odd == 1), F.lit("1.4")).otherwise(F.lit("1.0")).cast("decimal(3,1)")
    return customer.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k")).select(
        F.sha2(F.concat_ws("-", F.lit("c"), F.col("c_custkey").cast("string"), k.cast("string")), 256).alias("txn_id"),
        F.concat(F.lit("Sub "), (F.col("c_custkey") % 5).cast("string")).alias("merchant_clean"),
        F.lit("Subscriptions").alias("category_std"),
        F.concat(F.lit("acct_"), F.col("c_custkey").cast("string")).alias("account_id"),
        F.date_add(F.lit("2023-01-05").cast("date"), days.cast("int")).cast("timestamp_ntz").alias("posted_at"),
        (-(base * factor)).cast(MONEY).alias("amount_usd"),
        F.lit(True).alias("is_expense"),
    )


def event_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an expense of its user: few categories, right-skewed amounts, exact timestamps."""
    return read(spark, sf_dir, "events").select(
        F.sha2(F.concat(F.lit("e-"), F.col("event_id").cast("string")), 256).alias("txn_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("account_id"),
        F.col("ts").alias("posted_at"),
        F.date_format("ts", "yyyy-MM").alias("month"),
        (-F.col("value").cast(MONEY)).cast(MONEY).alias("amount"),
        (-F.col("value").cast(MONEY)).cast(MONEY).alias("amount_usd"),
        F.lit(True).alias("is_expense"),
        F.col("event_type").alias("category_std"),
        F.concat_ws(" ", F.col("event_type"), (F.col("user_id") % 50).cast("string")).alias("merchant_clean"),
    )
