"""Raw transactions to the standardised transaction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.dates import iso_week, month_key
from ledgermill.operators.exprs import small_side
from ledgermill.operators.merchant_rules import best_rules_joined
from ledgermill.operators.keyed_windows import MAX_GROUP_ROWS, running_total
from ledgermill.reference_data import FX_CURRENCIES, MERCHANT_RULES
from ledgermill.schemas import MONEY, RATE
from ledgermill.session import settle

DEFAULT_CATEGORY = "Other"


def normalise_merchants(
    raw: DataFrame, categories: DataFrame, rules: Sequence[tuple] | DataFrame = MERCHANT_RULES
) -> DataFrame:
    """Add ``merchant_clean`` and ``category_std``.

    A rule applies when its pattern occurs in the upper-cased merchant; lowest
    priority, then lowest rule id wins. Rules given as tuples are configuration and
    become one CASE expression: no join, no shuffle. Rules given as a table, of any number, are joined with the
    distinct merchants (``merchant_rules.best_rules``). A rule without a merchant
    keeps the raw text. Without a rule the raw category is used if it names a
    category. ``categories`` is left to Spark's own broadcast size check.
    """
    with_text = raw.withColumn("_text", F.upper("merchant_raw"))
    matched = best_rules_joined(with_text, rules) if isinstance(rules, DataFrame) else _rules_as_case(with_text, rules)
    names = categories.select(F.col("name").alias("_known_category"))
    return (
        matched.join(names, F.col("category_raw") == F.col("_known_category"), "left")
        .withColumns(
            {
                "merchant_clean": F.coalesce(F.col("_rule_merchant"), F.trim(F.col("merchant_raw")), F.lit("")),
                "category_std": F.coalesce(F.col("_rule_category"), F.col("_known_category"), F.lit(DEFAULT_CATEGORY)),
            }
        )
        .drop("_text", "_rule_merchant", "_rule_category", "_known_category")
    )


def _rules_as_case(with_text: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    ordered = sorted(rules, key=lambda r: (r[6], r[0]))
    position = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(ordered))):
        position = F.when(F.col("_text").contains(rule[1]), F.lit(i)).otherwise(position)

    def of_rule(field: int) -> Column:
        return F.get(F.array(*[F.lit(rule[field]).cast("string") for rule in ordered]), F.col("_rule"))

    found = with_text.withColumn("_rule", position)
    return found.withColumns({"_rule_merchant": of_rule(2), "_rule_category": of_rule(4)}).drop("_rule")


def in_usd(amount: Column, currency: Column) -> Column:
    """Amount over the day's USD->currency rate; a missing rate counts as 1, an unknown currency passes."""
    result = amount
    for code in FX_CURRENCIES:
        rate = F.coalesce(F.col(f"usd_to_{code.lower()}"), F.lit(1).cast(RATE))
        result = F.when(currency == code, amount / rate).otherwise(result)
    return result


def with_rates(df: DataFrame, fx_rates: DataFrame, day: Column) -> DataFrame:
    """Left join of the day's rates, which are one row per day."""
    rates = small_side(fx_rates).withColumnRenamed("date", "_fx_date")
    return df.join(rates, day == F.col("_fx_date"), "left").drop("_fx_date")


def convert_currency(raw: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Add ``amount_usd`` and ``amount_ccy``."""
    rate_columns = [f"usd_to_{c.lower()}" for c in FX_CURRENCIES]
    usd = F.round(in_usd(F.col("amount"), F.col("currency")), 2).cast(MONEY)
    return (
        with_rates(raw, fx_rates, F.to_date("posted_at"))
        .withColumns({"amount_usd": usd, "amount_ccy": F.lit("USD")})
        .drop(*rate_columns)
    )


def add_flags(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Add sign, month, week and the income/expense/transfer/investment flags."""
    groups = categories.select(F.col("name").alias("_category"), F.col("budget_group").alias("_group"))
    amount = F.col("amount")
    is_transfer = F.coalesce(F.col("_group").isin("Transfers", "Debt"), F.lit(False))
    is_investment = F.coalesce(F.col("_group") == "Investment", F.lit(False))
    return (
        df.join(groups, F.col("category_std") == F.col("_category"), "left")
        .withColumns(
            {
                "sign": F.signum(amount.cast("double")).cast("int"),
                "abs_amount": F.abs(amount),
                "is_debit": amount < 0,
                "month": month_key(F.col("posted_at")),
                "week": iso_week(F.to_date("posted_at")),
                "is_transfer": is_transfer,
                "is_investment": is_investment,
                "is_income": (amount > 0) & ~is_transfer & ~is_investment,
                "is_expense": (amount < 0) & ~is_transfer & ~is_investment,
                "is_recurring_guess": F.lit(False),
            }
        )
        .drop("_category", "_group")
    )


def stage(
    raw: DataFrame,
    fx_rates: DataFrame,
    categories: DataFrame,
    rules: Sequence[tuple] | DataFrame = MERCHANT_RULES,
) -> DataFrame:
    """The transaction table every mart reads. With rules as tuples it joins only small dimensions: no shuffle."""
    named = normalise_merchants(raw, categories, rules)
    return add_flags(convert_currency(named, fx_rates), categories)


def simple_view(stg: DataFrame) -> DataFrame:
    """The same rows under the column names of the simple marts."""
    return stg.withColumnsRenamed({"merchant_clean": "merchant_norm", "category_std": "category_norm"})


def running_balance(
    raw: DataFrame, opening: Column | float = 0, name: str = "balance_after", max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Cumulative amount per account, plus an opening balance."""
    opening = opening if isinstance(opening, Column) else F.lit(opening)
    total = running_total(raw, "account_id", "posted_at", "txn_id", "amount", name, max_group_rows=max_group_rows)
    return total.withColumn(name, (F.col(name) + opening.cast(MONEY)).cast("decimal(18,2)"))


def category_roots(categories: DataFrame) -> DataFrame:
    """``category_id, root_id`` by pointer jumping: each round doubles the steps that every category has climbed.

    A parent that is not in the table ends its chain. Parents that form a circle never end, which is an error.
    """
    ids = categories.select(F.col("category_id").alias("_id"))
    known = categories.join(ids, F.col("parent_id") == F.col("_id"), "left")
    now = settle(known.select("category_id", F.col("_id").alias("up")), "tree")
    for _ in range(max(now.count(), 1).bit_length() + 1):
        above = now.select(F.col("category_id").alias("_id"), F.col("up").alias("_further"))
        climbed = now.join(above, F.col("up") == F.col("_id"), "left")
        if not climbed.where(F.col("_further").isNotNull()).take(1):
            return now.select("category_id", F.coalesce("up", "category_id").alias("root_id"))
        now = settle(climbed.select("category_id", F.coalesce("_further", "up").alias("up")), "tree")
    raise ValueError("category parents form a circle")


def category_tree(categories: DataFrame) -> DataFrame:
    """Each category with its parent, and the name and group of its root, at any depth."""
    parent = categories.select(F.col("category_id").alias("_pid"), F.col("name").alias("parent_name"))
    root = categories.select(F.col("category_id").alias("root_id"), F.col("name").alias("root_name"), F.col("budget_group").alias("root_group"))
    return (
        categories.join(parent, F.col("parent_id") == F.col("_pid"), "left")
        .join(category_roots(categories), "category_id")
        .join(root, "root_id")
        .select("category_id", F.col("name").alias("category_name"), "budget_group", "parent_name", "root_name", "root_group")
    )


def category_rollup(stg: DataFrame, categories: DataFrame) -> DataFrame:
    """Transactions and amounts rolled up to the root categories."""
    per_category = stg.groupBy("category_std").agg(
        F.count("*").alias("transactions"), F.sum("amount_usd").alias("amount_usd")
    )
    tree = category_tree(categories)
    return (
        per_category.join(tree, F.col("category_std") == F.col("category_name"), "left")
        .groupBy(F.coalesce("root_name", "category_std").alias("root_name"), "root_group")
        .agg(
            F.count("*").alias("categories"),
            F.sum("transactions").alias("transactions"),
            F.sum("amount_usd").alias("amount_usd"),
        )
    )
