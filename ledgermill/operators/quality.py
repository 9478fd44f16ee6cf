"""Data-quality checks.

A suite is a list of checks on one table. All row-wise checks of a suite are
counted in one pass; uniqueness needs one grouped count per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.pii import PII_PATTERNS
from ledgermill.operators.exprs import small_side
from ledgermill.operators.keyed_windows import BLOCK_ROWS, MAX_GROUP_ROWS, rolling_rows
from ledgermill.reference_data import local_rows
from ledgermill.session import settle

KEYS = T.StructType([T.StructField("_i", T.IntegerType()), T.StructField("column", T.StringType())])
RESULTS = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("table", "check", "column")],
        *[T.StructField(c, T.LongType()) for c in ("checked", "failed")],
    ]
)

CARD_PATTERN = PII_PATTERNS["credit_card"]
HEX64 = r"^[a-f0-9]{64}$"
CURRENCY_CODE = r"^[A-Z]{3}$"
MONTH_TEXT = r"^\d{4}-\d{2}$"
AMOUNT_LIMIT = 1_000_000

# Accepted values per column.
SOURCES = ("bank", "card", "brokerage")
CURRENCIES = ("USD", "EUR", "GBP", "CAD", "AUD")
SEVERITIES = ("high", "medium", "low", "minimal")
RECURRING_TYPES = ("monthly", "weekly", "quarterly", "yearly", "likely_monthly", "likely_weekly", "irregular")
ACCOUNT_TYPES = ("checking", "savings", "credit", "brokerage")


@dataclass(frozen=True)
class Check:
    """``failed`` gives TRUE for a bad row. NULL values pass, except in not_null."""

    name: str
    column: str
    failed: Column | None = None
    unique_key: tuple[str, ...] = field(default=())


def not_null(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def in_range(column: str, low: float, high: float) -> Check:
    return Check("range", column, ~F.col(column).between(low, high))


def accepted(column: str, values: Sequence) -> Check:
    return Check("accepted_values", column, ~F.col(column).isin(*values))


def matches(column: str, pattern: str) -> Check:
    return Check("regex", column, ~F.col(column).rlike(pattern))


def not_matches(column: str, pattern: str) -> Check:
    return Check("not_regex", column, F.col(column).rlike(pattern))


def non_zero(column: str) -> Check:
    return Check("non_zero", column, F.col(column) == 0)


def parseable_date(column: str) -> Check:
    value = F.col(column)
    return Check("date_parseable", column, value.isNotNull() & value.cast("string").try_cast("timestamp_ntz").isNull())


def unique(*key: str) -> Check:
    return Check("unique", ",".join(key), unique_key=key)


def row_failures(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per row-wise check, all counted in the same scan."""
    counts = [
        F.count(F.when(F.coalesce(c.failed, F.lit(False)), 1)).alias(f"_{i}") for i, c in enumerate(checks)
    ]
    totals = df.agg(F.count("*").alias("_checked"), *counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table"),
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                F.col("_checked").alias("checked"),
                F.col(f"_{i}").alias("failed"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return totals.select(F.inline(rows))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def unique_failures(df: DataFrame, table: str, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Rows that share a key with another row, for all keys in one pass; NULL keys are left out.

    First 64-bit hashes of the keys are counted, so the shuffle holds no keys. Only rows whose hash repeats are read again and
    compared by their whole keys; a clean table is read once.
    """

    def entries(whole: bool) -> DataFrame:
        found = []
        for i, key in enumerate(keys):
            present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
            parts = [F.lit(i).alias("_i"), F.xxhash64(F.lit(i), *key).alias("_h")]
            parts += [F.to_json(F.struct(*key)).alias("_key")] if whole else []
            found.append(F.when(present, F.struct(*parts)))
        return df.select(F.inline(F.array_compact(F.array(*found))))

    hashes = settle(entries(False).groupBy("_i", "_h").agg(F.count("*").alias("n")), "key-hashes")
    counted = hashes.groupBy("_i").agg(F.sum("n").alias("checked"))
    suspects = hashes.where("n > 1").select("_i", "_h")
    if suspects.take(1):
        again = entries(True).join(small_side(suspects), ["_i", "_h"], "left_semi")
        sizes = again.groupBy("_i", "_key").agg(F.count("*").alias("n")).where("n > 1")
        counted = counted.join(sizes.groupBy("_i").agg(F.sum("n").alias("failed")), "_i", "left")
    else:
        counted = counted.withColumn("failed", F.lit(0).cast("long"))
    listed = local_rows(df.sparkSession, [(i, ",".join(key)) for i, key in enumerate(keys)], KEYS)
    return listed.join(counted, "_i", "left").select(
        F.lit(table).alias("table"),
        F.lit("unique").alias("check"),
        "column",
        F.coalesce("checked", F.lit(0)).alias("checked"),
        F.coalesce("failed", F.lit(0)).alias("failed"),
    )


@dataclass(frozen=True)
class Shape:
    """What a table's columns should be; ``types`` names accepted types by column."""

    types: Mapping[str, Sequence[str]] = field(default_factory=dict)
    ordered: Sequence[str] | None = None
    least: Sequence[str] | None = None
    rows: tuple[int, int] | None = None


def shape_failures(df: DataFrame, table: str, wanted: Shape) -> DataFrame:
    """Check rows of types (without a decimal's precision), columns and row count."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    found = [("type" if len(t) == 1 else "type_list", c, kinds.get(c) not in t) for c, t in wanted.types.items()]
    if wanted.ordered is not None:
        found.append(("columns_ordered", "*", list(df.columns) != list(wanted.ordered)))
    if wanted.least is not None:
        found.append(("columns_superset", "*", not set(wanted.least) <= set(df.columns)))
    rows = local_rows(df.sparkSession, [(table, check, column, 1, int(bad)) for check, column, bad in found], RESULTS)
    return rows.unionByName(row_count_between(df, table, *wanted.rows)) if wanted.rows else rows


def row_count_between(df: DataFrame, table: str, low: int, high: int) -> DataFrame:
    count = F.col("checked")
    return df.agg(F.count("*").alias("checked")).select(
        F.lit(table).alias("table"),
        F.lit("row_count").alias("check"),
        F.lit("*").alias("column"),
        "checked",
        F.when(count.between(low, high), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("failed"),
    )


def run_suite(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Rows (table, check, column, checked, failed, passed, score) of one suite."""
    parts = []
    row_wise = [c for c in checks if not c.unique_key]
    if row_wise:
        parts.append(row_failures(df, table, row_wise))
    keys = [c.unique_key for c in checks if c.unique_key]
    if keys:
        parts.append(unique_failures(df, table, keys))
    return score(reduce(DataFrame.unionByName, parts))


def score(results: DataFrame) -> DataFrame:
    checked, failed = F.col("checked"), F.col("failed")
    return results.withColumns(
        {
            "passed": failed == 0,
            "score": F.when(checked > 0, (checked - failed) / checked * 100).otherwise(F.lit(0.0)),
        }
    )


def run_checkpoint(suites: Sequence[tuple[str, DataFrame, Sequence[Check]]]) -> DataFrame:
    """All suites of a checkpoint in one result. Each table is stored first and then read by its checks only."""
    return reduce(DataFrame.unionByName, [run_suite(settle(df, table), table, checks) for table, df, checks in suites])


def checkpoint_summary(results: DataFrame) -> DataFrame:
    """Passed and total checks per table."""
    return results.groupBy("table").agg(
        F.count(F.when(F.col("passed"), 1)).alias("checks_passed"),
        F.count("*").alias("total_checks"),
        F.avg("score").alias("quality_score"),
    )


def raw_suite() -> list[Check]:
    required = ["txn_id", "source", "account_id", "posted_at", "amount", "currency", "balance_after", "ingest_batch_id"]
    return [
        *[not_null(c) for c in required],
        unique("txn_id"),
        unique("hash_raw"),
        in_range("amount", -AMOUNT_LIMIT, AMOUNT_LIMIT),
        accepted("source", SOURCES),
        accepted("currency", CURRENCIES),
        matches("txn_id", HEX64),
        matches("currency", CURRENCY_CODE),
        parseable_date("posted_at"),
        not_matches("merchant_raw", CARD_PATTERN),
        not_matches("description_raw", CARD_PATTERN),
        non_zero("amount"),
    ]


def staging_suite() -> list[Check]:
    flags = ["is_income", "is_expense", "is_transfer", "is_investment"]
    required = ["txn_id", "amount_usd", "amount_ccy", "sign", "month", "merchant_clean", "category_std"]
    return [
        *[not_null(c) for c in required],
        unique("txn_id"),
        in_range("amount_usd", -AMOUNT_LIMIT, AMOUNT_LIMIT),
        in_range("sign", -1, 1),
        accepted("amount_ccy", ["USD"]),
        accepted("sign", [1, -1, 0]),
        *[accepted(c, [True, False]) for c in flags],
        matches("month", MONTH_TEXT),
    ]


def mart_suites() -> dict[str, list[Check]]:
    """Checks per mart. Keys are the grain of each mart."""
    return {
        "cashflow_daily": [
            *[not_null(c) for c in ("date", "account_id", "income", "expenses", "savings_rate")],
            unique("date", "account_id", "source"),
            in_range("savings_rate", 0, 1),
        ],
        "cashflow_monthly": [
            *[not_null(c) for c in ("month", "income", "expenses", "savings_rate")],
            unique("month", "account_id", "source"),
            in_range("savings_rate", 0, 1),
        ],
        "net_worth": [
            *[not_null(c) for c in ("date", "net_worth", "total_assets", "total_liabilities")],
            unique("date"),
        ],
        "budget_vs_actual": [
            *[not_null(c) for c in ("month", "category_name", "budget_target", "actual_expenses", "variance")],
            unique("month", "category_name"),
        ],
        "recurring": [
            *[not_null(c) for c in ("merchant_name", "recurring_type", "confidence_score")],
            accepted("recurring_type", RECURRING_TYPES),
            in_range("confidence_score", 0, 1),
        ],
        "anomalies": [
            *[not_null(c) for c in ("txn_id", "anomaly_score", "severity", "anomaly_type")],
            unique("txn_id"),
            in_range("anomaly_score", 0, 100),
            accepted("severity", SEVERITIES),
        ],
        "forecasts": [
            *[
                not_null(c)
                for c in ("forecast_date", "forecast_type", "category_name", "forecast_amount", "confidence_level")
            ],
            accepted("forecast_type", ["total", "category"]),
            in_range("confidence_level", 0, 1),
        ],
    }


def account_suite() -> list[Check]:
    return [
        not_null("account_id"),
        not_null("institution"),
        not_null("type"),
        not_null("currency"),
        unique("account_id"),
        accepted("type", ACCOUNT_TYPES),
    ]


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    present = child.filter(F.col(child_key).isNotNull())
    return present.join(known, F.col(child_key) == F.col("_parent_key"), "left_anti")


def foreign_key(child: DataFrame, parent: DataFrame, table: str, child_key: str, parent_key: str) -> DataFrame:
    """Check row of a foreign key.

    Child keys are counted before the join, so a key that many rows share
    travels once per map task.
    """
    keys = child.groupBy(F.col(child_key).alias("_child_key")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    joined = keys.join(known, F.col("_child_key") == F.col("_parent_key"), "left")
    bad = F.col("_child_key").isNotNull() & F.col("_parent_key").isNull()
    result = joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(bad, F.col("n")).otherwise(F.lit(0))), F.lit(0)).alias("failed"),
    )
    return score(
        result.select(
            F.lit(table).alias("table"),
            F.lit("foreign_key").alias("check"),
            F.lit(child_key).alias("column"),
            "checked",
            "failed",
        )
    )


def balance_breaks(raw: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Transactions whose balance is not the account's previous balance plus their amount."""
    rows = raw.filter(F.col("balance_after").isNotNull()).select(
        "txn_id", "account_id", "posted_at", "amount", "balance_after"
    )
    pair = {
        "previous_balance": lambda w: F.first("balance_after").over(w),
        "_rows": lambda w: F.count("*").over(w),
    }
    with_previous = rolling_rows(
        rows, "account_id", "posted_at", "txn_id", 1, pair, max_group_rows=max_group_rows, block_rows=block_rows
    )
    return (
        with_previous.filter(F.col("_rows") == 2)
        .filter(F.col("balance_after") - F.col("previous_balance") != F.col("amount"))
        .drop("_rows")
    )
