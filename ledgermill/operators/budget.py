"""Budget against actual expenses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.dates import month_start
from ledgermill.operators.exprs import last_rows, mean_money, num, pct_change, ratio, rolling_means
from ledgermill.reference_data import BUDGET_TARGETS, BUDGET_VARIANCE_THRESHOLD, DEFAULT_BUDGET_TARGET
from ledgermill.schemas import MONEY

ROLLED = ("actual_expenses", "budget_target", "variance", "variance_pct")


def target_of(category: Column, named: Mapping[str, float] = BUDGET_TARGETS) -> Column:
    target = F.lit(DEFAULT_BUDGET_TARGET)
    for name, value in named.items():
        target = F.when(category == name, F.lit(value)).otherwise(target)
    return target.cast(MONEY)


def targets(stg: DataFrame) -> DataFrame:
    """Target per expense category that occurs in the ledger."""
    found = stg.filter("is_expense").select("category_std").distinct()
    return found.withColumn("budget_target", target_of(F.col("category_std")))


def budget_vs_actual(stg: DataFrame, budget_targets: DataFrame | None = None) -> DataFrame:
    """One row per month and expense category.

    Transactions are aggregated to month and category before anything else; the
    target join and all windows see months times categories rows. Without a
    target table the fixed targets become an expression on that result.
    """
    spent = F.abs(F.col("amount_usd"))
    monthly = (
        stg.filter("is_expense")
        .groupBy("month", "category_std")
        .agg(
            F.sum(spent).alias("actual_expenses"),
            F.count("*").alias("transaction_count"),
            mean_money(spent).alias("avg_transaction_amount"),
            F.max(spent).alias("max_transaction_amount"),
            F.min(spent).alias("min_transaction_amount"),
        )
    )
    if budget_targets is None:
        monthly = monthly.withColumn("budget_target", target_of(F.col("category_std")))
    else:
        monthly = monthly.join(budget_targets, "category_std", "left").withColumn(
            "budget_target", F.coalesce(F.col("budget_target"), F.lit(0)).cast(MONEY)
        )
    actual, target = num("actual_expenses"), num("budget_target")
    first = month_start(F.col("month"))
    monthly = monthly.withColumns(
        {
            "variance": F.col("actual_expenses") - F.col("budget_target"),
            "variance_pct": ratio(actual - target, target, None) * 100,
            "budget_utilization_pct": ratio(actual, target, None) * 100,
            "budget_status": F.when(actual > target * (1 + BUDGET_VARIANCE_THRESHOLD), "over_budget")
            .when(actual < target * (1 - BUDGET_VARIANCE_THRESHOLD), "under_budget")
            .otherwise("on_budget"),
            "year": F.year(first),
            "month_num": F.month(first),
            "quarter": F.quarter(first),
        }
    )
    spans = (3, 6, 12)
    monthly = rolling_means(monthly, ["category_std"], "month", ROLLED[:3], spans, "m")
    windows = {
        f"variance_pct_{s}m_avg": F.avg("variance_pct").over(last_rows(["category_std"], ["month"], s - 1)) for s in spans
    }
    by_month = Window.partitionBy("category_std").orderBy("month")
    short = {"actual_expenses": "actual", "budget_target": "budget"}
    for label, step in (("month", 1), ("year", 12)):
        for metric in ROLLED:
            windows[f"prev_{label}_{short.get(metric, metric)}"] = F.lag(metric, step).over(by_month)
    changes = {}
    for label, tag in (("month", "mom"), ("year", "yoy")):
        before = f"prev_{label}_actual"
        changes[f"actual_{tag}_change"] = F.col("actual_expenses") - F.col(before)
        changes[f"actual_{tag}_change_pct"] = pct_change(actual, num(before))
        for metric in ("variance", "variance_pct"):
            changes[f"{metric}_{tag}_change"] = F.col(metric) - F.col(f"prev_{label}_{metric}")
    return monthly.withColumns(windows).withColumns(changes).withColumnRenamed("category_std", "category_name")
