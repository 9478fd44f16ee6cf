"""Daily and monthly cashflow marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.dates import iso_week
from ledgermill.operators.exprs import count_if, last_rows, mean_money, num, pct_change, ratio, rolling_means, savings_rate, sum_if

FLOWS = {"income": "is_income", "expenses": "is_expense", "transfers": "is_transfer", "investments": "is_investment"}
SPANS = (7, 30, 90)


def cashflow_daily(stg: DataFrame) -> DataFrame:
    """One row per date, account and source.

    The only shuffle of transactions is the grouped aggregation, combined
    map-side. The rolling windows run on its output: at most one row per day and
    source in an account, whatever the account's share of the ledger.
    """
    amount = F.col("amount_usd")
    aggregates = []
    for name, flag in FLOWS.items():
        value = F.abs(amount) if name == "expenses" else amount
        aggregates.append(sum_if(F.col(flag), value).alias(name))
        singular = {"expenses": "expense"}.get(name, name.rstrip("s"))
        aggregates.append(count_if(F.col(flag)).alias(f"{singular}_transactions"))
    daily = stg.groupBy(F.to_date("posted_at").alias("date"), "account_id", "source").agg(
        *aggregates,
        F.sum(amount).alias("net_amount"),
        F.count("*").alias("total_transactions"),
        F.max("balance_after").alias("closing_balance"),
        F.min("balance_after").alias("opening_balance"),
    )
    day = F.col("date")
    daily = daily.withColumns(
        {
            "savings_rate": savings_rate("income", "expenses"),
            "balance_delta": F.col("closing_balance") - F.col("opening_balance"),
            "transaction_density": num("total_transactions"),
            "income_expense_ratio": ratio(num("income"), num("expenses"), None),
            "net_worth_change": F.col("net_amount"),
            "year": F.year(day),
            "month": F.date_format(day, "yyyy-MM"),
            "day": F.dayofmonth(day),
            "day_of_week": F.dayofweek(day),
            "quarter": F.quarter(day),
            "week": iso_week(day),
        }
    )
    keys = ["account_id", "source"]
    daily = rolling_means(daily, keys, "date", ["income", "expenses"], SPANS, "d")
    rates = {s: F.avg("savings_rate").over(last_rows(keys, ["date"], s - 1)) for s in SPANS}
    return daily.withColumns({f"savings_rate_{s}d_avg": mean for s, mean in rates.items()})


def cashflow_monthly(daily: DataFrame) -> DataFrame:
    """Month, account and source, from the daily mart."""
    counts = ["income", "expense", "transfer", "investment", "total"]
    rolling = [f"{m}_{s}d_avg" for s in SPANS for m in ("income", "expenses", "savings_rate")]
    monthly = daily.groupBy("month", "account_id", "source").agg(
        *[F.sum(c).alias(c) for c in [*FLOWS, "net_amount"]],
        *[F.sum(f"{c}_transactions").alias(f"{c}_transactions") for c in counts],
        mean_money("income").alias("avg_daily_income"),
        mean_money("expenses").alias("avg_daily_expenses"),
        F.avg("total_transactions").alias("avg_daily_transactions"),
        mean_money("closing_balance").alias("avg_balance"),
        F.max("closing_balance").alias("max_balance"),
        F.min("opening_balance").alias("min_balance"),
        F.sum("balance_delta").alias("total_balance_delta"),
        F.avg("savings_rate").alias("avg_savings_rate"),
        F.max("savings_rate").alias("max_savings_rate"),
        F.min("savings_rate").alias("min_savings_rate"),
        *[F.avg(c).alias(c) for c in rolling],
        F.min("date").alias("month_start"),
        F.max("date").alias("month_end"),
        # the group holds one row per date, so counting rows counts dates
        F.count("date").alias("active_days"),
    )
    spread = num("max_balance") - num("min_balance")
    start = F.col("month_start")
    monthly = monthly.withColumns(
        {
            "savings_rate": savings_rate("income", "expenses"),
            "income_expense_ratio": ratio(num("income"), num("expenses"), None),
            "transactions_per_day": F.col("total_transactions") / F.greatest(F.col("active_days"), F.lit(1)),
            "balance_volatility": ratio(spread, F.col("avg_balance"), 0.0),
            "year": F.year(start),
            "month_num": F.month(start),
            "quarter": F.quarter(start),
        }
    )
    by_month = Window.partitionBy("account_id", "source").orderBy("month")
    monthly = monthly.withColumns(
        {
            f"prev_{label}_{metric}": F.lag(metric, step).over(by_month)
            for label, step in (("month", 1), ("year", 12))
            for metric in ("income", "expenses", "savings_rate")
        }
    )
    changes = {}
    for short, label in (("mom", "month"), ("yoy", "year")):
        for metric in ("income", "expenses"):
            changes[f"{metric}_{short}_change"] = pct_change(num(metric), num(f"prev_{label}_{metric}"))
        changes[f"savings_rate_{short}_change"] = F.col("savings_rate") - F.col(f"prev_{label}_savings_rate")
    return monthly.withColumns(changes)
