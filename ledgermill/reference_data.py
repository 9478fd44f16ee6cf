"""Seed rows of the reference tables and other fixed values.

Results depend on these values, so they are written out as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgermill import schemas

# Category seed (category_id, parent_id, name, budget_group, is_income).
CATEGORIES = [
    (1, None, "Income", "Income", True),
    (2, 1, "Salary", "Income", True),
    (3, 1, "Bonus", "Income", True),
    (4, 1, "Interest", "Income", True),
    (5, 1, "Dividend", "Income", True),
    (6, 1, "Investment Gains", "Income", True),
    (7, None, "Expenses", "Expenses", False),
    (8, 7, "Food & Dining", "Expenses", False),
    (9, 7, "Groceries", "Expenses", False),
    (10, 7, "Restaurants", "Expenses", False),
    (11, 7, "Transportation", "Expenses", False),
    (12, 7, "Gas", "Expenses", False),
    (13, 7, "Public Transit", "Expenses", False),
    (14, 7, "Entertainment", "Expenses", False),
    (15, 7, "Streaming", "Expenses", False),
    (16, 7, "Technology", "Expenses", False),
    (17, 7, "Software", "Expenses", False),
    (18, 7, "Hardware", "Expenses", False),
    (19, 7, "Healthcare", "Expenses", False),
    (20, 7, "Insurance", "Expenses", False),
    (21, 7, "Utilities", "Expenses", False),
    (22, 7, "Rent/Mortgage", "Expenses", False),
    (23, 7, "Online Shopping", "Expenses", False),
    (24, 7, "Clothing", "Expenses", False),
    (25, 7, "Transfers", "Transfers", False),
    (26, 7, "Cash", "Transfers", False),
    (27, 7, "Debt Payment", "Debt", False),
    (28, 7, "Investment", "Investment", False),
    (29, 7, "Other", "Other", False),
]

# The category set of the simple (v1) marts.
SIMPLE_CATEGORIES = [
    (1, None, "Salary", "Income", True),
    (2, None, "Freelance", "Income", True),
    (3, None, "Investment Returns", "Income", True),
    (4, None, "Food & Dining", "Essential", False),
    (5, None, "Transportation", "Essential", False),
    (6, None, "Housing", "Essential", False),
    (7, None, "Utilities", "Essential", False),
    (8, None, "Entertainment", "Discretionary", False),
    (9, None, "Shopping", "Discretionary", False),
    (10, None, "Healthcare", "Essential", False),
]

# Merchant rule seed
# (rule_id, pattern, merchant_clean, mcc, category_std, risk_flag, priority).
MERCHANT_RULES = [
    (1, "AMAZON", "Amazon", "5999", "Online Shopping", False, 1),
    (2, "STARBUCKS", "Starbucks", "5814", "Food & Dining", False, 1),
    (3, "NETFLIX", "Netflix", "7841", "Entertainment", False, 1),
    (4, "SPOTIFY", "Spotify", "7841", "Entertainment", False, 1),
    (5, "UBER", "Uber", "4121", "Transportation", False, 1),
    (6, "LYFT", "Lyft", "4121", "Transportation", False, 1),
    (7, "APPLE", "Apple", "5732", "Technology", False, 1),
    (8, "GOOGLE", "Google", "5732", "Technology", False, 1),
    (9, "MICROSOFT", "Microsoft", "5732", "Technology", False, 1),
    (10, "ADOBE", "Adobe", "5732", "Technology", False, 1),
    (11, "TRANSFER", "Transfer", "6010", "Transfers", False, 2),
    (12, "PAYMENT", "Payment", "6010", "Transfers", False, 2),
    (13, "REFUND", "Refund", "6010", "Transfers", False, 2),
    (14, "ATM", "ATM Withdrawal", "6011", "Cash", False, 2),
    (15, "DEPOSIT", "Deposit", "6010", "Income", False, 2),
    (16, "SALARY", "Salary", "6010", "Income", False, 2),
    (17, "BONUS", "Bonus", "6010", "Income", False, 2),
    (18, "INTEREST", "Interest", "6010", "Income", False, 2),
    (19, "DIVIDEND", "Dividend", "6010", "Investment", False, 2),
    (20, "CREDIT CARD", "Credit Card Payment", "6010", "Debt Payment", False, 2),
]

# Monthly budget target per category, and the target of all others.
BUDGET_TARGETS = {
    "Food & Dining": 500.0,
    "Groceries": 300.0,
    "Transportation": 200.0,
    "Entertainment": 150.0,
    "Technology": 100.0,
    "Healthcare": 200.0,
    "Utilities": 150.0,
    "Online Shopping": 200.0,
    "Clothing": 100.0,
}
DEFAULT_BUDGET_TARGET = 50.0

# Monthly budget per group of the simple marts, and of all others.
GROUP_BUDGETS = {"Essential": 2000.0, "Discretionary": 1000.0}
DEFAULT_GROUP_BUDGET = 500.0

# Currencies with a rate column.
FX_CURRENCIES = ("EUR", "GBP", "CAD", "AUD")

# Tunables.
FORECAST_HORIZON_MONTHS = 3
ANOMALY_THRESHOLD = 20
BUDGET_VARIANCE_THRESHOLD = 0.1


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Fixed rows as a local relation, whose size Spark knows exactly when it picks a join."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema.fields)
    table = pa.table({f.name: pa.array(c, to_arrow_type(f.dataType)) for f, c in zip(schema.fields, columns)})
    return spark.createDataFrame(table, schema)


def categories(spark: SparkSession, rows: Sequence[tuple] = CATEGORIES) -> DataFrame:
    return local_rows(spark, rows, schemas.CATEGORY)


def simple_categories(spark: SparkSession) -> DataFrame:
    return local_rows(spark, SIMPLE_CATEGORIES, schemas.CATEGORY)
