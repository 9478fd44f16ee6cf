"""The simple (v1) marts: sign-based, without currency or flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.dates import day
from ledgermill.operators.exprs import count_if, mean_money, num, rounded_rate, sum_if
from ledgermill.reference_data import DEFAULT_GROUP_BUDGET, FORECAST_HORIZON_MONTHS, GROUP_BUDGETS
from ledgermill.schemas import MONEY
from ledgermill.session import settle

AMOUNT = "amount"


def _flows() -> list[Column]:
    amount = F.col(AMOUNT)
    return [
        sum_if(amount > 0, amount).alias("income"),
        sum_if(amount < 0, F.abs(amount)).alias("expenses"),
        F.count("*").alias("transaction_count"),
        F.sum(amount).alias("balance_delta"),
    ]


def _savings_rate() -> Column:
    return rounded_rate(F.col("income") - F.col("expenses"), F.col("income"))


def mart_cashflow_daily(simple: DataFrame) -> DataFrame:
    """Totals and balance change per date, in one aggregation."""
    daily = simple.groupBy(F.to_date("posted_at").alias("date")).agg(*_flows())
    return daily.withColumn("savings_rate", _savings_rate())


def mart_cashflow_monthly(simple: DataFrame) -> DataFrame:
    """Totals per month; days are aggregated first, which also counts the active days."""
    amount = F.col(AMOUNT)
    daily = simple.groupBy("month", F.to_date("posted_at").alias("date")).agg(
        *_flows(),
        count_if(amount > 0).alias("n_income"),
        count_if(amount < 0).alias("n_expense"),
    )
    monthly = daily.groupBy("month").agg(
        F.sum("income").alias("income"),
        F.sum("expenses").alias("expenses"),
        F.sum("transaction_count").alias("transaction_count"),
        F.count("*").alias("active_days"),
        F.sum("balance_delta").alias("balance_delta"),
        F.sum("n_income").alias("n_income"),
        F.sum("n_expense").alias("n_expense"),
    )
    return monthly.withColumns(
        {
            "savings_rate": _savings_rate(),
            "avg_income": F.when(F.col("n_income") > 0, num("income") / F.col("n_income")),
            "avg_expense": F.when(F.col("n_expense") > 0, num("expenses") / F.col("n_expense")),
        }
    ).drop("n_income", "n_expense")


def group_budget() -> Column:
    group = F.col("budget_group")
    budget = F.when(F.col("is_income"), F.lit(0.0)).otherwise(F.lit(DEFAULT_GROUP_BUDGET))
    for name, value in GROUP_BUDGETS.items():
        budget = F.when(group == name, F.lit(value)).otherwise(budget)
    return budget.cast(MONEY)


def mart_budget(simple: DataFrame, categories: DataFrame) -> DataFrame:
    """Group budget against net amount per month and category."""
    amount = F.col(AMOUNT)
    totals = simple.groupBy("month", "category_norm").agg(
        sum_if(amount > 0, amount).alias("income"),
        sum_if(amount < 0, F.abs(amount)).alias("expenses"),
    )
    budgets = categories.select(
        "category_id", F.col("name").alias("category_name"), "budget_group", group_budget().alias("budget")
    ).filter("budget > 0")
    variance = F.col("budget") - F.col("actual")
    return (
        totals.join(budgets, F.col("category_norm") == F.col("category_name"))
        .withColumn("actual", F.col("income") - F.col("expenses"))
        .select(
            "month",
            "category_id",
            "category_name",
            "budget_group",
            "budget",
            "actual",
            variance.alias("variance"),
            rounded_rate(variance, F.col("budget")).alias("variance_pct"),
            "income",
            "expenses",
        )
    )


def mart_recurring(simple: DataFrame, as_of: date, least: int = 2) -> DataFrame:
    """Merchant and category pairs that were charged at least ``least`` times.

    The mean gap between consecutive payments is the whole span over the number
    of gaps, so no ordered window is needed.
    """
    spent = F.abs(num(AMOUNT))
    pairs = (
        simple.filter(F.col(AMOUNT) < 0)
        .groupBy("merchant_norm", "category_norm")
        .agg(
            F.count("*").alias("occurrence_count"),
            F.round(F.sum(F.abs(AMOUNT)) / F.count("*"), 2).alias("average_amount"),
            F.stddev_samp(spent).alias("amount_stddev"),
            F.min("posted_at").alias("first_seen"),
            F.max("posted_at").alias("last_seen"),
        )
        .filter(F.col("occurrence_count") >= least)
    )
    seconds = F.unix_timestamp("last_seen") - F.unix_timestamp("first_seen")
    gap = seconds / F.lit(86400.0) / (F.col("occurrence_count") - 1)
    whole_seconds = F.round(F.col("avg_days_between") * 86400).cast("decimal(18,6)")
    last_day = F.to_date("last_seen")
    return pairs.withColumn("avg_days_between", gap).select(
        "merchant_norm",
        "category_norm",
        "occurrence_count",
        "average_amount",
        F.round("amount_stddev", 2).alias("amount_stddev"),
        "first_seen",
        "last_seen",
        "avg_days_between",
        F.to_date(F.col("last_seen") + F.make_dt_interval(secs=whole_seconds)).alias("next_due_date"),
        F.when(F.col("avg_days_between") <= 7, "Weekly")
        .when(F.col("avg_days_between") <= 31, "Monthly")
        .when(F.col("avg_days_between") <= 90, "Quarterly")
        .otherwise("Annual")
        .alias("frequency"),
        F.when(last_day >= F.date_sub(day(as_of), 30), "Active")
        .when(last_day >= F.date_sub(day(as_of), 90), "Recent")
        .otherwise("Inactive")
        .alias("status"),
    )


def daily_z_scores(simple: DataFrame, least: int = 3) -> DataFrame:
    """Expenses with their z-score in the date and category.

    The statistics are aggregated map-side and stored; Spark knows their size then and broadcasts them, so the
    expenses stay where they are. Where they are too large for that, the join is on (date, category).
    """
    spent = F.abs(num(AMOUNT))
    expenses = simple.filter(F.col(AMOUNT) < 0).withColumn("date", F.to_date("posted_at"))
    stats = (
        expenses.groupBy("date", "category_norm")
        .agg(
            mean_money(F.abs(AMOUNT)).alias("avg_amount"),
            F.stddev_samp(spent).alias("std_amount"),
            F.count("*").alias("transaction_count"),
        )
        .filter(F.col("transaction_count") >= least)
    )
    stats = settle(stats, "day-stats")
    std, excess = F.col("std_amount"), F.abs(num(AMOUNT)) - F.col("avg_amount")
    return (
        expenses.join(stats, ["date", "category_norm"])
        .withColumns(
            {
                "z_score": F.when(std > 0, excess / std).otherwise(F.lit(0.0)),
                "is_outlier": F.coalesce((std > 0) & (excess > 2 * std), F.lit(False)),
            }
        )
        .select(
            "txn_id",
            "posted_at",
            "date",
            "merchant_norm",
            "category_norm",
            AMOUNT,
            "avg_amount",
            "std_amount",
            "transaction_count",
            "z_score",
            "is_outlier",
        )
    )


def anomaly_daily_z(simple: DataFrame) -> DataFrame:
    """Statistical outliers of their date and category."""
    z = F.col("z_score")
    return (
        daily_z_scores(simple)
        .filter(F.col("is_outlier") | (F.abs(z) > 2))
        .withColumns(
            {
                "anomaly_type": F.lit("Statistical Outlier"),
                "severity": F.when(F.abs(z) > 3, "High").when(F.abs(z) > 2, "Medium").otherwise("Low"),
                "driver": F.when(z > 0, "Unusually high expense").otherwise("Unusually low expense"),
                "remediation_hint": F.when(z > 0, "Verify transaction amount and necessity").otherwise(
                    "Check for missing transactions or refunds"
                ),
            }
        )
    )


def _novel(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "anomaly_type": F.lit("Novel Merchant"),
            "severity": F.lit("Medium"),
            "driver": F.lit("Merchant not seen in last 90 days"),
            "remediation_hint": F.lit("Review transaction and categorize appropriately"),
        }
    )


def novel_merchant_90d(simple: DataFrame, days: int = 90) -> DataFrame:
    """Transactions without an earlier one of the same merchant in the last ``days`` days.

    Only a merchant's first timestamp of a day can qualify, and what precedes it
    is the last timestamp of the merchant's previous active day. So merchants are
    reduced to (day, first, last) map-side, and a busy merchant is a few thousand
    rows in the window. The rows come back by (merchant, timestamp).
    """
    known = simple.filter(F.col("merchant_norm").isNotNull())
    active = known.groupBy("merchant_norm", F.to_date("posted_at").alias("_day")).agg(
        F.min("posted_at").alias("_first"), F.max("posted_at").alias("_last")
    )
    before = F.lag("_last").over(Window.partitionBy("merchant_norm").orderBy("_day"))
    first_seen = (
        active.withColumn("_before", before)
        .filter(
            F.col("_before").isNull()
            | (F.col("_before") < F.col("_first") - F.make_dt_interval(days=F.lit(days)))
        )
        .select(F.col("merchant_norm").alias("_merchant"), "_first")
    )
    rows = known.join(
        first_seen,
        (F.col("merchant_norm") == F.col("_merchant")) & (F.col("posted_at") == F.col("_first")),
        "left_semi",
    )
    return _novel(rows)


def mart_anomalies(simple: DataFrame) -> DataFrame:
    """Outliers and novel merchants together, with a repeatable id."""
    columns = ["txn_id", "anomaly_type", "severity", "driver", "remediation_hint", "posted_at"]
    both = anomaly_daily_z(simple).select(*columns).unionByName(novel_merchant_90d(simple).select(*columns))
    return both.withColumn("id", F.xxhash64("txn_id", "anomaly_type"))


def _recent(simple: DataFrame, as_of: date, days: int) -> Column:
    return F.col("posted_at") >= F.date_sub(day(as_of), days).cast("timestamp_ntz")


def anomaly_pop_z(simple: DataFrame, as_of: date, days: int = 30, least: int = 3) -> DataFrame:
    """Recent expenses more than two population deviations from their category's mean."""
    recent = simple.filter((F.col(AMOUNT) < 0) & _recent(simple, as_of, days))
    spent = F.abs(num(AMOUNT))
    stats = (
        recent.groupBy("category_norm")
        .agg(mean_money(F.abs(AMOUNT)).alias("mean"), F.stddev_pop(spent).alias("std"), F.count("*").alias("n"))
        .filter((F.col("n") >= least) & (F.col("std") > 0))
    )
    stats = settle(stats, "category-stats")
    z = F.abs((spent - F.col("mean")) / F.col("std"))
    return (
        recent.join(stats, "category_norm")
        .withColumn("z_score", z)
        .filter("z_score > 2")
        .select(
            "txn_id",
            "category_norm",
            F.lit("Statistical Outlier").alias("anomaly_type"),
            F.when(F.col("z_score") > 3, "High").otherwise("Medium").alias("severity"),
            F.lit("Z-score outlier").alias("driver"),
            F.lit("Verify transaction amount and necessity").alias("remediation_hint"),
            "z_score",
        )
    )


def novel_merchant_30d(simple: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Recent expenses at merchants without any earlier transaction."""
    earlier = simple.filter(~_recent(simple, as_of, days)).select(F.col("merchant_norm").alias("_seen")).distinct()
    recent = simple.filter((F.col(AMOUNT) < 0) & _recent(simple, as_of, days))
    rows = recent.join(earlier, F.col("merchant_norm") == F.col("_seen"), "left_anti")
    return _novel(rows).select(
        "txn_id", "merchant_norm", "anomaly_type", "severity", "driver", "remediation_hint"
    )


def mart_forecasts(simple: DataFrame, categories: DataFrame, as_of: date, least: int = 3) -> DataFrame:
    """Mean monthly expense plus a linear step, for the next three months."""
    spent = F.abs(AMOUNT)
    monthly = (
        simple.filter(F.col(AMOUNT) < 0)
        .groupBy("month", "category_norm")
        .agg(F.sum(spent).alias("expenses"), F.count("*").alias("n"))
        .filter(F.col("n") >= least)
    )
    n = F.count("*")
    slope = F.when(n > 1, (num(F.max("expenses")) - num(F.min("expenses"))) / F.nullif(n - 1, F.lit(0))).otherwise(0.0)
    growth = monthly.groupBy("category_norm").agg(
        mean_money("expenses").alias("avg_monthly_expense"),
        slope.alias("monthly_growth_rate"),
        F.stddev_samp(num("expenses")).alias("expense_volatility"),
    )
    spending = categories.filter(~F.col("is_income")).select(
        "category_id", F.col("name").alias("category_name"), "budget_group"
    )
    ahead = F.explode(F.sequence(F.lit(1), F.lit(FORECAST_HORIZON_MONTHS))).alias("months_ahead")
    mean, volatility = F.col("avg_monthly_expense"), F.col("expense_volatility")
    projected = F.col("_projected")
    return (
        growth.join(spending, F.col("category_norm") == F.col("category_name"))
        .select("*", ahead)
        .withColumn("_projected", mean + F.col("monthly_growth_rate") * F.col("months_ahead"))
        .select(
            F.add_months(day(as_of), F.col("months_ahead")).alias("forecast_date"),
            "category_id",
            "category_name",
            "budget_group",
            F.round(projected, 2).alias("forecast_amount"),
            F.round(F.greatest(projected - volatility, F.lit(0.0)), 2).alias("lower_bound"),
            F.round(projected + volatility, 2).alias("upper_bound"),
            F.when(volatility < mean * 0.1, 0.95)
            .when(volatility < mean * 0.25, 0.80)
            .otherwise(0.65)
            .alias("confidence_level"),
            "avg_monthly_expense",
            "monthly_growth_rate",
            "expense_volatility",
        )
    )
