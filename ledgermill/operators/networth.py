"""Daily net worth mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.operators.exprs import count_if, num, pct_change, ratio, rolling_means, sum_if
from ledgermill.operators.staging import in_usd, with_rates

SPANS = (7, 30, 90)
# rows back in the daily series
LOOKBACKS = {"day": ("dod", 1), "week": ("wow", 7), "month": ("mom", 30), "year": ("yoy", 365)}


def account_days(stg: DataFrame) -> DataFrame:
    """First and last balance of each account and day.

    ``min_by``/``max_by`` combine map-side, so a busy account costs one row per
    day and map task in the shuffle.
    """
    order = F.struct("posted_at", "txn_id")
    return (
        stg.filter(F.col("balance_after").isNotNull())
        .groupBy("account_id", F.to_date("posted_at").alias("date"))
        .agg(
            F.max_by(F.struct("balance_after", "source", "currency"), order).alias("_last"),
            F.min_by("balance_after", order).alias("opening_balance"),
        )
        .select(
            "account_id",
            "date",
            "_last.source",
            "_last.currency",
            F.col("_last.balance_after").alias("daily_balance"),
            "opening_balance",
        )
    )


def _usd(balance: str) -> Column:
    return F.round(in_usd(F.col(balance), F.col("currency")), 2).cast("decimal(18,2)")


def _sums(days: DataFrame) -> DataFrame:
    """Sums per date over the accounts that have transactions on it."""
    close, opening, kind, owed = F.col("_close"), F.col("_open"), F.col("_type"), F.col("_liability")
    return days.groupBy("date").agg(
        sum_if(~owed, close).alias("total_assets"),
        sum_if(~owed, opening).alias("opening_assets"),
        sum_if(owed, F.abs(close)).alias("total_liabilities"),
        sum_if(owed, F.abs(opening)).alias("opening_liabilities"),
        sum_if(kind == "checking", close).alias("checking_balance"),
        sum_if(kind == "savings", close).alias("savings_balance"),
        sum_if(kind == "credit", F.abs(close)).alias("credit_balance"),
        sum_if(kind == "investment", close).alias("investment_balance"),
        # one row per account and date, so rows are distinct accounts
        count_if(~owed).alias("asset_accounts"),
        count_if(owed).alias("liability_accounts"),
        F.count("*").alias("total_accounts"),
    )


def _carried_sums(days: DataFrame) -> DataFrame:
    """Sums per date over all accounts known by then, idle ones with their last balance in the dollars of its day.

    A balance changes only on the days of its account: the changes are summed per date and accumulated over the dates, so
    there is no row for an idle account. An account's window is bounded by its days, the last one by the calendar.
    """
    close, opening, kind, owed = F.col("_close"), F.col("_open"), F.col("_type"), F.col("_liability")
    zero, one = F.lit(0).cast("decimal(18,2)"), F.lit(1).cast("long")
    own = {
        "total_assets": F.when(~owed, close).otherwise(zero),
        "total_liabilities": F.when(owed, F.abs(close)).otherwise(zero),
        "checking_balance": F.when(kind == "checking", close).otherwise(zero),
        "savings_balance": F.when(kind == "savings", close).otherwise(zero),
        "credit_balance": F.when(kind == "credit", F.abs(close)).otherwise(zero),
        "investment_balance": F.when(kind == "investment", close).otherwise(zero),
        "asset_accounts": F.when(~owed, one).otherwise(0 * one),
        "liability_accounts": F.when(owed, one).otherwise(0 * one),
        "total_accounts": one,
    }
    before = Window.partitionBy("account_id").orderBy("date")
    # the opening of a day differs from its close by what moved on it
    moved = {
        "opening_assets": F.when(~owed, opening - close).otherwise(zero),
        "opening_liabilities": F.when(owed, F.abs(opening) - F.abs(close)).otherwise(zero),
    }
    steps = days.withColumns(own).withColumns(moved)
    steps = steps.withColumns({f"_{c}": F.col(c) - F.coalesce(F.lag(c).over(before), F.lit(0)) for c in own})
    per_day = steps.groupBy("date").agg(*[F.sum(f"_{c}").alias(c) for c in own], *[F.sum(c).alias(c) for c in moved])
    until = Window.partitionBy().orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    kinds = {c: "long" if c.endswith("accounts") else "decimal(28,2)" for c in own}
    totals = per_day.withColumns({c: F.sum(c).over(until).cast(kinds[c]) for c in own})
    return totals.withColumns(
        {
            "opening_assets": F.col("total_assets") + F.col("opening_assets"),
            "opening_liabilities": F.col("total_liabilities") + F.col("opening_liabilities"),
        }
    )


def net_worth(stg: DataFrame, fx_rates: DataFrame, carry_forward: bool = False) -> DataFrame:
    """One row per date that has transactions, over the accounts with transactions on it or, carried forward, over all.

    The un-partitioned windows at the end see one row per calendar day.
    """
    account, source = F.col("account_id"), F.col("source")
    days = with_rates(account_days(stg), fx_rates, F.col("date")).withColumns(
        {
            "_close": _usd("daily_balance"),
            "_open": _usd("opening_balance"),
            "_type": F.when((source == "bank") & account.like("%checking%"), "checking")
            .when((source == "bank") & account.like("%savings%"), "savings")
            .when(source == "card", "credit")
            .when(source == "brokerage", "investment")
            .otherwise("other"),
            "_liability": source == "card",
        }
    )
    per_day = _carried_sums(days) if carry_forward else _sums(days)
    assets, day = num("total_assets"), F.col("date")
    per_day = per_day.withColumns(
        {
            "net_worth": F.col("total_assets") - F.col("total_liabilities"),
            "opening_net_worth": F.col("opening_assets") - F.col("opening_liabilities"),
        }
    ).withColumns(
        {
            "net_worth_change": F.col("net_worth") - F.col("opening_net_worth"),
            "checking_pct": ratio(num("checking_balance"), assets, 0.0),
            "savings_pct": ratio(num("savings_balance"), assets, 0.0),
            "investment_pct": ratio(num("investment_balance"), assets, 0.0),
            "debt_to_asset_ratio": ratio(num("total_liabilities"), assets, None),
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            "quarter": F.quarter(day),
            "day_of_week": F.dayofweek(day),
        }
    )
    per_day = rolling_means(per_day, [], "date", ["net_worth", "net_worth_change"], SPANS, "d")
    in_order = Window.partitionBy().orderBy("date")
    windows = {
        f"prev_{label}_net_worth": F.lag("net_worth", rows).over(in_order) for label, (_, rows) in LOOKBACKS.items()
    }
    now = F.col("net_worth")
    changes = {}
    for label, (short, _) in LOOKBACKS.items():
        before = F.col(f"prev_{label}_net_worth")
        changes[f"net_worth_{short}_change"] = now - before
        changes[f"net_worth_{short}_change_pct"] = pct_change(num(now), num(before))
    return per_day.withColumns(windows).withColumns(changes)


def account_balances(raw: DataFrame, institution: str = "source") -> DataFrame:
    """Latest balance per account."""
    latest = F.max_by(
        F.struct("balance_after", "currency", F.col(institution).alias("institution"), "posted_at"),
        F.struct("posted_at", "txn_id"),
    )
    return (
        raw.filter(F.col("balance_after").isNotNull())
        .groupBy("account_id")
        .agg(latest.alias("_l"))
        .select(
            "account_id",
            "_l.institution",
            F.col("_l.balance_after").alias("current_balance"),
            F.col("_l.posted_at").alias("last_updated"),
            "_l.currency",
        )
    )
