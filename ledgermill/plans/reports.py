"""Report queries over the marts. Totals are separate one-row frames."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.functions.dates import day
from ledgermill.operators.exprs import num, pct_change, ratio, savings_rate
from ledgermill.operators.materialize import stored_months


def _struct(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _month_totals(monthly: DataFrame, account: str | None) -> DataFrame:
    """One row per month over all (or one) accounts, with the previous month's values."""
    if account is not None:
        monthly = monthly.filter(F.col("account_id") == account)
    totals = (
        monthly.groupBy("month")
        .agg(F.sum("income").alias("income"), F.sum("expenses").alias("expenses"))
        .withColumn("savings_rate", savings_rate("income", "expenses"))
    )
    in_order = Window.partitionBy().orderBy("month")
    return totals.withColumns({f"prev_{c}": F.lag(c).over(in_order) for c in ("income", "expenses", "savings_rate")})


def kpis(monthly: DataFrame, period: str, account: str | None = None) -> DataFrame:
    """Income, expenses, savings rate and net cash flow of a month."""
    row = _month_totals(monthly, account).filter(F.col("month") == period)
    income, expenses = num("income"), num("expenses")
    zero = F.lit(0.0)
    income_change = F.coalesce(pct_change(income, num("prev_income")), zero)
    expense_change = F.coalesce(pct_change(expenses, num("prev_expenses")), zero)
    rate_change = F.coalesce(F.col("savings_rate") - F.col("prev_savings_rate"), zero)

    def trend(change: Column) -> Column:
        return F.when(change > 0, "up").otherwise("down")

    rows = F.array(
        _struct(
            metric_name=F.lit("Total Income"),
            value=income,
            unit=F.lit("USD"),
            change_pct=income_change,
            trend=trend(income_change),
            definition=F.lit("Total income for the period"),
        ),
        _struct(
            metric_name=F.lit("Total Expenses"),
            value=expenses,
            unit=F.lit("USD"),
            change_pct=expense_change,
            trend=trend(expense_change),
            definition=F.lit("Total expenses for the period"),
        ),
        _struct(
            metric_name=F.lit("Savings Rate"),
            value=F.col("savings_rate") * 100,
            unit=F.lit("%"),
            change_pct=rate_change * 100,
            trend=trend(rate_change),
            definition=F.lit("Percentage of income saved"),
        ),
        _struct(
            metric_name=F.lit("Net Cash Flow"),
            value=income - expenses,
            unit=F.lit("USD"),
            change_pct=F.lit(None).cast("double"),
            trend=F.when(income > expenses, "positive").otherwise("negative"),
            definition=F.lit("Income minus expenses"),
        ),
    )
    return row.select("month", F.inline(rows))


def category_kpi(budget: DataFrame, period: str, category: str) -> DataFrame:
    """Expenses of one category in a month, with its change on the month before."""
    change = F.coalesce(F.col("actual_mom_change_pct"), F.lit(0.0))
    return budget.filter((F.col("month") == period) & (F.col("category_name") == category)).select(
        "month",
        F.lit("Total Expenses").alias("metric_name"),
        num("actual_expenses").alias("value"),
        F.lit("USD").alias("unit"),
        change.alias("change_pct"),
        F.when(change > 0, "up").otherwise("down").alias("trend"),
        F.lit("Total expenses for the period").alias("definition"),
    )


def cashflow(
    daily: DataFrame, as_of: date, grain: str = "month", months: int = 12, account: str | None = None
) -> DataFrame:
    """Newest periods first. A week averages its daily savings rates, as the daily mart has them."""
    since = F.trunc(F.add_months(day(as_of), -months), "month")
    rows = daily.filter(F.col("date") >= since)
    if account is not None:
        rows = rows.filter(F.col("account_id") == account)
    period, limit = {
        "daily": (F.col("date").cast("string"), months * 30),
        "weekly": (F.col("week"), months * 4),
        "month": (F.col("month"), months),
    }[grain]
    rate = F.avg("savings_rate") if grain == "weekly" else savings_rate(F.sum("income"), F.sum("expenses"))
    return (
        rows.groupBy(period.alias("period"))
        .agg(
            F.sum("income").alias("income"),
            F.sum("expenses").alias("expenses"),
            rate.alias("savings_rate"),
            F.sum("balance_delta").alias("balance_delta"),
            F.sum("total_transactions").alias("transaction_count"),
        )
        .orderBy(F.desc("period"))
        .limit(limit)
    )


def cashflow_totals(rows: DataFrame) -> DataFrame:
    """Totals of a cashflow report; the rate is recomputed from them."""
    totals = rows.agg(F.sum("income").alias("total_income"), F.sum("expenses").alias("total_expenses"))
    return totals.withColumn("overall_savings_rate", savings_rate("total_income", "total_expenses"))


def budget_month(budget: DataFrame, month: str) -> DataFrame:
    return (
        budget.filter(F.col("month") == month)
        .select(
            "month",
            "category_name",
            F.col("budget_target").alias("budget"),
            F.col("actual_expenses").alias("actual"),
            "variance",
            "variance_pct",
            "budget_status",
        )
        .orderBy(F.abs("variance_pct").desc_nulls_last(), "category_name")
    )


def budget_totals(rows: DataFrame) -> DataFrame:
    totals = rows.agg(F.sum("budget").alias("total_budget"), F.sum("actual").alias("total_actual"))
    return totals.withColumn("overall_variance", F.col("total_actual") - F.col("total_budget"))


def anomalies_recent(anomalies: DataFrame, limit: int = 50, severity: str | None = None) -> DataFrame:
    if severity is not None:
        anomalies = anomalies.filter(F.col("severity") == severity)
    return (
        anomalies.select(
            "txn_id", "anomaly_type", "severity", "driver", "remediation_hint", "posted_at", "acknowledged"
        )
        .orderBy(F.desc("posted_at"), "txn_id")
        .limit(limit)
    )


def anomalies_recent_stored(spark: SparkSession, path: str, limit: int = 50, severity: str | None = None) -> DataFrame:
    """``anomalies_recent`` over an exported mart: months are read from the newest on until they hold ``limit`` rows.

    Each try reads twice as many months as the one before. Rows without a date, which come last, are read if all others are too few.
    """
    months = stored_months(spark, path)
    if not months:
        return anomalies_recent(spark.read.parquet(path), limit, severity)
    taken = 1
    while True:
        rows = anomalies_recent(spark.read.option("basePath", path).parquet(*months[:taken]), limit, severity)
        if taken >= len(months) or rows.count() >= limit:
            return rows
        taken *= 2


def anomaly_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("total_anomalies"),
        F.count(F.when(F.col("severity") == "high", 1)).alias("high_severity_count"),
        F.count(F.when(~F.col("acknowledged"), 1)).alias("unacknowledged_count"),
    )


def forecasts(forecast: DataFrame, horizon: str = "3_months", category: str | None = None) -> DataFrame:
    rows = forecast.filter(F.col("forecast_horizon") == horizon)
    if category is not None:
        rows = rows.filter(F.col("category_name") == category)
    return rows.select(
        "forecast_date",
        "forecast_type",
        "category_name",
        "forecast_amount",
        "lower_bound",
        "upper_bound",
        "confidence_level",
        "forecast_quality",
    ).orderBy("forecast_date", "forecast_type", "category_name")


def forecast_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.coalesce(F.sum("forecast_amount"), F.lit(0.0)).alias("total_forecast_amount"),
        F.coalesce(F.avg("confidence_level"), F.lit(0.0)).alias("average_confidence"),
        F.count("*").alias("forecasts"),
    )


def recurring_confirmed(recurring: DataFrame) -> DataFrame:
    return recurring.filter("is_confirmed_recurring").select(
        "merchant_name",
        "category_name",
        "account_id",
        "recurring_type",
        "confidence_score",
        "avg_amount",
        "next_expected_date",
        "days_until_next",
        "status",
    )


def recurring_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.coalesce(F.sum("avg_amount"), F.lit(0.0)).alias("total_recurring_amount"),
        F.count("*").alias("confirmed_recurring_count"),
    )


def net_worth_trend(net_worth: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Daily net worth of the last days, with its change over 30 and 90 rows."""
    in_order = Window.partitionBy().orderBy("date")
    before_30, before_90 = num("prev_month_net_worth"), F.col("_back_90")
    now = num("net_worth")
    return (
        net_worth.withColumn("_back_90", num(F.lag("net_worth", 90).over(in_order)))
        .filter(F.col("date") >= F.date_sub(day(as_of), days))
        .select(
            "date",
            "net_worth",
            "total_assets",
            "total_liabilities",
            "net_worth_change",
            F.coalesce("net_worth_dod_change_pct", F.lit(0.0)).alias("net_worth_change_pct"),
            F.when(before_30 > 0, now - before_30).otherwise(F.lit(0.0)).alias("net_worth_change_30d"),
            F.when(before_90 > 0, now - before_90).otherwise(F.lit(0.0)).alias("net_worth_change_90d"),
        )
        .orderBy(F.desc("date"))
        .limit(days)
    )


def savings_drivers(monthly: DataFrame, budget: DataFrame, period: str, top: int = 10) -> DataFrame:
    """The month's largest expense categories with their share of all expenses."""
    spent = _month_totals(monthly, None).select("month", num("expenses").alias("_expenses"))
    impact, variance = num("actual_expenses"), F.coalesce("variance_pct", F.lit(0.0))
    signed = F.concat(F.when(variance >= 0, "+").otherwise(""), variance.cast("decimal(18,1)").cast("string"))
    return (
        budget.filter(F.col("month") == period)
        .join(spent, "month")
        .select(
            "month",
            F.lit("expense_category").alias("driver_type"),
            F.col("category_name").alias("driver_name"),
            impact.alias("impact"),
            (ratio(impact, F.col("_expenses"), 0.0) * 100).alias("impact_pct"),
            F.concat(
                F.lit("Expenses in "),
                F.col("category_name"),
                F.lit(": $"),
                F.format_number(F.col("actual_expenses"), 2),
                F.lit(" ("),
                signed,
                F.lit("% vs budget)"),
            ).alias("description"),
            F.col("variance_pct"),
        )
        .orderBy(F.desc("impact"), "driver_name")
        .limit(top)
    )


# Recommendation texts.
LOW_SAVINGS = "Consider reducing discretionary spending to increase savings rate"
HIGH_EXPENSES = "Review and optimize recurring expenses"
OVER_BUDGET = "Address budget overruns in high-variance categories"


def explain_savings(monthly: DataFrame, budget: DataFrame, period: str) -> DataFrame:
    """Savings of a month and the recommendations that apply."""
    overruns = (
        savings_drivers(monthly, budget, period)
        .groupBy("month")
        .agg(F.max(F.coalesce("variance_pct", F.lit(0.0))).alias("_worst"))
    )
    income, expenses, rate = num("income"), num("expenses"), F.col("savings_rate")
    advice = F.array_compact(
        F.array(
            F.when(rate < 0.2, LOW_SAVINGS),
            F.when(expenses > income * 0.8, HIGH_EXPENSES),
            F.when(F.col("_worst") > 20, OVER_BUDGET),
        )
    )
    return (
        _month_totals(monthly, None)
        .filter(F.col("month") == period)
        .join(overruns, "month", "left")
        .select(
            F.col("month").alias("period"),
            (income - expenses).alias("total_savings"),
            "savings_rate",
            F.concat_ws("; ", advice).alias("recommendations"),
        )
    )


def platform_summary(raw: DataFrame, anomalies: DataFrame, forecast: DataFrame, as_of: date) -> DataFrame:
    """Row counts, and the share of anomalies with a score below 50."""
    zero = F.lit(0).cast("long")
    names = ["total_transactions", "today_transactions", "total_anomalies", "_calm", "total_forecasts"]

    def counts(df: DataFrame, **found: Column) -> DataFrame:
        return df.agg(*[found.get(n, F.max(zero)).alias(n) for n in names])

    parts = [
        counts(
            raw,
            total_transactions=F.count("*"),
            today_transactions=F.count(F.when(F.to_date("posted_at") >= day(as_of), 1)),
        ),
        counts(anomalies, total_anomalies=F.count("*"), _calm=F.count(F.when(F.col("anomaly_score") < 50, 1))),
        counts(forecast, total_forecasts=F.count("*")),
    ]
    merged = reduce(DataFrame.unionByName, parts).agg(*[F.sum(n).alias(n) for n in names])
    quality = F.when(F.col("total_anomalies") > 0, F.col("_calm") / F.col("total_anomalies") * 100).otherwise(100.0)
    return merged.withColumns(
        {"data_quality_score": F.round(quality, 1), "system_health": F.lit("healthy")}
    ).drop("_calm")


def daily_since(simple_daily: DataFrame, since: date, limit: int = 100) -> DataFrame:
    """Newest days of the simple daily mart."""
    rows = simple_daily.filter(F.col("date") >= day(since)).select("date", "income", "expenses")
    return rows.orderBy(F.desc("date")).limit(limit)


def category_totals(budget: DataFrame, since_month: str) -> DataFrame:
    rows = budget.filter(F.col("month") >= since_month)
    return rows.groupBy("category_name").agg(F.sum("actual_expenses").alias("total")).orderBy(F.desc("total"))


def monthly_trends(simple_monthly: DataFrame, since_month: str) -> DataFrame:
    rows = simple_monthly.filter(F.col("month") >= since_month)
    return rows.select("month", "income", "expenses", "savings_rate").orderBy(F.desc("month"))


def balance_totals(balances: DataFrame) -> DataFrame:
    """Total balance per currency."""
    return balances.groupBy("currency").agg(
        F.sum("current_balance").alias("total_balance"), F.count("*").alias("accounts")
    )
