"""Recurring payment detection."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.dates import day
from ledgermill.operators.exprs import num

# Class, least occurrences, interval band in days, interval CV and amount CV limits.
CLASSES = [
    ("monthly", 3, 25, 35, 0.3, 0.2),
    ("weekly", 3, 6, 8, 0.3, 0.2),
    ("quarterly", 3, 80, 95, 0.3, 0.2),
    ("yearly", 3, 360, 375, 0.3, 0.2),
    ("likely_monthly", 2, 25, 35, 0.5, 0.3),
    ("likely_weekly", 2, 6, 8, 0.5, 0.3),
]
# Confidence, least occurrences, interval CV and amount CV limits.
CONFIDENCE = [(0.95, 6, 0.2, 0.1), (0.85, 4, 0.3, 0.2), (0.70, 3, 0.4, 0.3), (0.50, 2, 0.5, 0.4)]
# Upper CV limits of the interval and amount bands.
PERIODICITY = [(0.1, "very_regular"), (0.2, "regular"), (0.3, "somewhat_regular"), (0.5, "irregular")]
STABILITY = [(0.05, "very_stable"), (0.1, "stable"), (0.2, "somewhat_stable"), (0.3, "variable")]


def _band(value: Column, limits: list[tuple[float, str]], otherwise: str) -> Column:
    result = F.lit(otherwise)
    for limit, name in reversed(limits):
        result = F.when(value < limit, name).otherwise(result)
    return result


def _sample_std(squares: Column, n: Column) -> Column:
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def payment_statistics(stg: DataFrame) -> DataFrame:
    """Interval and amount statistics per merchant and account, one row per category.

    Expenses are first reduced to one row per merchant, account, category and
    date (combined map-side), so the ordered window sees days, not transactions.
    Same-day repeats are gaps of zero days; they count in the mean and the
    deviation without being listed.
    """
    spent = F.abs(num("amount_usd"))
    by_day = (
        stg.filter(F.col("is_expense") & (F.col("merchant_clean") != ""))
        .groupBy("merchant_clean", "account_id", "category_std", F.to_date("posted_at").alias("date"))
        .agg(
            F.count("*").alias("n"),
            F.avg(spent).alias("mean"),
            F.var_pop(spent).alias("var"),
        )
    )
    pair = ["merchant_clean", "account_id"]
    whole = Window.partitionBy(*pair)
    ordered = whole.orderBy("date", "category_std")
    gap = F.datediff("date", F.lag("date").over(ordered)).cast("double")
    by_day = by_day.withColumns(
        {
            "gap": gap,
            "total": F.sum("n").over(whole),
            "avg_amount": F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole),
            "first_date": F.min("date").over(whole),
            "last_date": F.max("date").over(whole),
        }
    )
    between = F.col("n") * F.pow(F.col("mean") - F.col("avg_amount"), 2)
    by_day = by_day.withColumns(
        {
            "gap_squares": F.sum(F.col("gap") * F.col("gap")).over(whole),
            "amount_squares": F.sum(F.col("n") * F.col("var") + between).over(whole),
        }
    )
    gaps = F.col("total") - 1
    span = F.datediff("last_date", "first_date").cast("double")
    mean_gap, mean_amount = F.col("avg_interval_days"), F.col("avg_amount")
    squares = F.coalesce(F.col("gap_squares"), F.lit(0.0)) - gaps * mean_gap * mean_gap
    statistics = (
        by_day.withColumn("avg_interval_days", F.when(gaps > 0, span / gaps))
        .withColumn("interval_stddev", _sample_std(F.greatest(squares, F.lit(0.0)), gaps))
        .withColumn("amount_stddev", _sample_std(F.col("amount_squares"), F.col("total")))
        .withColumn("interval_cv", F.col("interval_stddev") / F.nullif(mean_gap, F.lit(0.0)))
        .withColumn("amount_cv", F.col("amount_stddev") / F.nullif(mean_amount, F.lit(0.0)))
    )
    kept = ["avg_interval_days", "interval_stddev", "interval_cv", "avg_amount", "amount_stddev", "amount_cv"]
    # constant per pair; as outputs of an aggregation they are plain columns for the filter on the class,
    # which would otherwise repeat their formulas for every class
    return statistics.groupBy(*pair, "category_std").agg(
        F.first("total").alias("total_transactions"),
        *[F.first(c).alias(c) for c in kept],
        F.min("date").alias("first_transaction_date"),
        F.max("date").alias("last_transaction_date"),
    )


def recurring(stg: DataFrame, as_of: date) -> DataFrame:
    """Merchants that are paid at a steady interval with a steady amount."""
    n, gap = F.col("total_transactions"), F.col("avg_interval_days")
    icv, acv = F.col("interval_cv"), F.col("amount_cv")
    kind = F.lit("irregular")
    for name, least, low, high, max_icv, max_acv in reversed(CLASSES):
        hit = (n >= least) & gap.between(low, high) & (icv < max_icv) & (acv < max_acv)
        kind = F.when(hit, name).otherwise(kind)
    confidence = F.lit(0.20)
    for value, least, max_icv, max_acv in reversed(CONFIDENCE):
        confidence = F.when((n >= least) & (icv < max_icv) & (acv < max_acv), F.lit(value)).otherwise(confidence)
    last, found = F.col("last_transaction_date"), F.col("recurring_type")
    months = F.when(found == "quarterly", 3).when(found == "yearly", 12).otherwise(1)
    due = F.when(found.endswith("weekly"), F.date_add(last, 7)).otherwise(F.add_months(last, months))
    left = F.col("days_until_next")
    return (
        payment_statistics(stg)
        .withColumns({"recurring_type": kind, "confidence_score": confidence})
        .filter(F.col("recurring_type") != "irregular")
        .withColumn("next_expected_date", due)
        .withColumn("days_until_next", F.datediff("next_expected_date", day(as_of)))
        .select(
            F.col("merchant_clean").alias("merchant_name"),
            F.col("category_std").alias("category_name"),
            "account_id",
            "recurring_type",
            "confidence_score",
            "total_transactions",
            "avg_interval_days",
            "interval_stddev",
            "interval_cv",
            _band(icv, PERIODICITY, "highly_irregular").alias("periodicity_score"),
            "avg_amount",
            "amount_stddev",
            "amount_cv",
            (F.col("avg_amount") - F.col("amount_stddev")).alias("expected_min_amount"),
            (F.col("avg_amount") + F.col("amount_stddev")).alias("expected_max_amount"),
            _band(acv, STABILITY, "highly_variable").alias("amount_stability"),
            "first_transaction_date",
            "last_transaction_date",
            "next_expected_date",
            "days_until_next",
            F.when(left < 0, "overdue")
            .when(left <= 7, "due_soon")
            .when(left <= 30, "upcoming")
            .otherwise("future")
            .alias("status"),
            (~found.startswith("likely_")).alias("is_confirmed_recurring"),
            found.startswith("likely_").alias("is_likely_recurring"),
        )
    )
