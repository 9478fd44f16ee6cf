"""Short-horizon forecasts from monthly series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.dates import day, month_start
from ledgermill.operators.exprs import last_rows, num, ratio, rolling_means, sum_if
from ledgermill.reference_data import FORECAST_HORIZON_MONTHS

# Confidence, limits of the absolute trend and of the volatility.
CONFIDENCE = [(0.85, 0.1, 0.2), (0.70, 0.2, 0.3), (0.55, 0.3, 0.4)]
LOWEST_CONFIDENCE = 0.40
# Confidence factor per month ahead.
DECAY = {1: 1.0, 2: 0.9, 3: 0.8}


def monthly_series(stg: DataFrame, as_of: date | None = None, months: int = 24) -> DataFrame:
    """Monthly totals as series: total income, total expenses, expenses per category.

    Transactions are aggregated once, to month and category; the totals are
    summed from that.
    """
    if as_of is not None:
        stg = stg.filter(F.col("posted_at") >= F.add_months(day(as_of), -months).cast("timestamp_ntz"))
    amount = F.col("amount_usd")
    per_category = stg.groupBy("month", "category_std").agg(
        sum_if(F.col("is_income"), amount).alias("income"),
        sum_if(F.col("is_expense"), F.abs(amount)).alias("expenses"),
    )

    def entry(kind: str, name: Column, value: str) -> Column:
        return F.struct(F.lit(kind).alias("forecast_type"), name.alias("category_name"), F.col(value).alias("value"))

    entries = per_category.select(
        "month",
        F.inline(
            F.array(
                entry("total", F.lit("Income"), "income"),
                entry("total", F.lit("Expenses"), "expenses"),
                entry("category", F.col("category_std"), "expenses"),
            )
        ),
    )
    return entries.groupBy("forecast_type", "category_name", "month").agg(F.sum("value").alias("value"))


def with_trend(series: DataFrame) -> DataFrame:
    """Add the 3-month mean, the last month's trend, its volatility and the confidence."""
    key = ["forecast_type", "category_name"]
    by_month = Window.partitionBy(*key).orderBy("month")
    before = num("_before")
    trended = (
        rolling_means(series, key, "month", ["value"], [3], "m")
        .withColumnRenamed("value_3m_avg", "mean_3m")
        .withColumn("_before", F.lag("value").over(by_month))
        .withColumn("trend", ratio(num("value") - before, before, 0.0))
        .withColumn("volatility", F.stddev_samp("trend").over(last_rows(key, ["month"], 11)))
    )
    size, volatility = F.abs("trend"), F.col("volatility")
    confidence = F.lit(LOWEST_CONFIDENCE)
    for value, max_trend, max_volatility in reversed(CONFIDENCE):
        confidence = F.when((size < max_trend) & (volatility < max_volatility), F.lit(value)).otherwise(confidence)
    return trended.withColumn("confidence", confidence).drop("_before")


def _project(trended: DataFrame) -> DataFrame:
    """Forecast 1..3 months ahead of each row of a series."""
    growth = 1 + F.col("trend")
    steps = []
    amount: Column = F.col("mean_3m")
    for h in range(1, FORECAST_HORIZON_MONTHS + 1):
        amount = amount * growth
        horizon = "1_month" if h == 1 else f"{h}_months"
        steps.append(
            F.struct(
                F.lit(h).alias("h"),
                F.lit(horizon).alias("forecast_horizon"),
                amount.alias("forecast_amount"),
                (F.col("confidence") * DECAY[h]).alias("confidence_level"),
            )
        )
    return trended.select("*", F.inline(F.array(*steps)))


def forecast(stg: DataFrame, as_of: date) -> DataFrame:
    """Next three months of every series, from each series' last month."""
    key = ["forecast_type", "category_name"]
    trended = with_trend(monthly_series(stg, as_of))
    newest = F.max("month").over(Window.partitionBy(*key))
    latest = trended.withColumn("_newest", newest).filter(F.col("month") == F.col("_newest")).drop("_newest")
    amount, confidence = F.col("forecast_amount"), F.col("confidence")
    width = F.col("forecast_range")
    level, volatility = F.col("confidence_level"), F.col("volatility")
    return (
        _project(latest)
        .withColumns(
            {
                "forecast_date": F.add_months(month_start(F.col("month")), F.col("h")),
                "lower_bound": amount * (1 - confidence),
                "upper_bound": amount * (1 + confidence),
            }
        )
        .withColumn("forecast_range", F.col("upper_bound") - F.col("lower_bound"))
        .select(
            "forecast_date",
            "forecast_horizon",
            *key,
            "forecast_amount",
            "lower_bound",
            "upper_bound",
            "confidence_level",
            "volatility",
            "forecast_range",
            ratio(width, amount, 1.0).alias("forecast_precision"),
            F.when(level >= 0.8, "high")
            .when(level >= 0.6, "medium")
            .when(level >= 0.4, "low")
            .otherwise("very_low")
            .alias("forecast_quality"),
            F.when(volatility < 0.1, "low_risk")
            .when(volatility < 0.2, "medium_risk")
            .when(volatility < 0.3, "high_risk")
            .otherwise("very_high_risk")
            .alias("risk_level"),
        )
    )


def forecast_linear(simple: DataFrame, categories: DataFrame, as_of: date) -> DataFrame:
    """Last monthly expense plus the mean monthly step, per category of the last six months."""
    since = F.date_format(F.add_months(day(as_of), -6), "yyyy-MM")
    monthly = (
        simple.filter((F.col("amount") < 0) & (F.col("month") >= since))
        .groupBy("month", "category_norm")
        .agg(F.sum(F.abs("amount")).alias("expenses"), F.count("*").alias("n"))
        .filter("n >= 3")
    )
    per_category = (
        monthly.groupBy("category_norm")
        .agg(
            F.count("*").alias("n"),
            num(F.min_by("expenses", "month")).alias("first"),
            num(F.max_by("expenses", "month")).alias("last"),
            F.stddev_pop(num("expenses")).alias("volatility"),
        )
        .filter("n >= 2")
        .withColumn("slope", (F.col("last") - F.col("first")) / (F.col("n") - 1))
    )
    ahead = F.explode(F.sequence(F.lit(1), F.lit(FORECAST_HORIZON_MONTHS))).alias("i")
    amount, volatility = F.col("amount"), F.col("volatility")
    zero = F.lit(0.0)
    named = categories.select("category_id", F.col("name").alias("category_norm"))
    return (
        per_category.join(named, "category_norm")
        .select("*", ahead)
        .withColumn("amount", F.col("last") + F.col("slope") * F.col("i"))
        .select(
            F.date_add(day(as_of), 30 * F.col("i")).alias("forecast_date"),
            "category_id",
            "category_norm",
            F.greatest(amount, zero).alias("forecast_amount"),
            F.greatest(amount - volatility, zero).alias("lower_bound"),
            (amount + volatility).alias("upper_bound"),
            F.lit(0.8).alias("confidence_level"),
        )
    )


def forecast_backtest(stg: DataFrame) -> DataFrame:
    """Rolling-origin errors: every month of a series forecasts the following three."""
    trended = with_trend(monthly_series(stg))
    actual = trended.select(
        F.col("forecast_type").alias("_t"),
        F.col("category_name").alias("_c"),
        F.col("month").alias("_m"),
        num("value").alias("actual"),
    )
    made = _project(trended).withColumn(
        "target", F.date_format(F.add_months(month_start(F.col("month")), F.col("h")), "yyyy-MM")
    )
    paired = made.join(
        actual,
        (F.col("forecast_type") == F.col("_t"))
        & (F.col("category_name") == F.col("_c"))
        & (F.col("target") == F.col("_m")),
    )
    error = F.col("actual") - F.col("forecast_amount")
    return paired.groupBy("forecast_type", "category_name", "forecast_horizon").agg(
        F.count("*").alias("forecasts"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(F.col("actual") != 0, F.abs(error / F.col("actual")))) * 100).alias("mape"),
    )
