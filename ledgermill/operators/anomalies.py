"""Scored anomalies over rolling statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgermill.operators.exprs import num
from ledgermill.operators.keyed_windows import BLOCK_ROWS, MAX_GROUP_ROWS, find_skew, rolling_rows
from ledgermill.reference_data import ANOMALY_THRESHOLD
from ledgermill.session import settle

ROWS_BACK = 29

# Points per flag, and the share and limit of each z-score.
POINTS = {
    "is_statistical_outlier": 25,
    "is_amount_spike": 20,
    "is_novel_merchant": 15,
    "is_unusual_timing": 10,
    "is_high_frequency": 15,
    "is_category_mismatch": 10,
}
Z_POINTS, Z_LIMIT = 5, 15
# Least score per severity.
SEVERITY = [(70, "high"), (40, "medium"), (20, "low")]
# Words in a merchant name and the categories that fit them.
EXPECTED_CATEGORIES = [
    ("restaurant", ("Food & Dining", "Restaurants")),
    ("gas", ("Transportation", "Gas")),
    ("grocery", ("Food & Dining", "Groceries")),
]
# Categories that are unusual on a weekend (1 = Sunday, 7 = Saturday).
WEEKDAY_CATEGORIES = ("Business", "Professional Services")
# Anomaly types in order of precedence; the driver text of each, around up to two numbers.
TYPES = [
    ("Statistical Outlier + Amount Spike", "Transaction amount is ", "x the category average and ", "x the merchant average"),
    ("Statistical Outlier", "Transaction amount is ", " standard deviations from category average", ""),
    ("Amount Spike", "Transaction amount is ", "x the category average", ""),
    ("Novel Merchant", "First transaction with this merchant in the last 30 days", "", ""),
    ("Unusual Timing", "Transaction occurred at an unusual time for this category", "", ""),
    ("High Frequency", "High frequency of transactions with this merchant (", " in 30 days)", ""),
    ("Category Mismatch", "Category classification may be incorrect for this merchant", "", ""),
    ("Multiple Factors", "Multiple anomaly factors detected", "", ""),
]
# Remediation texts in order of precedence.
HINTS = [
    "Review transaction details and verify amount. Consider if this is a legitimate large purchase.",
    "Verify this is a legitimate merchant. Check for potential fraud or data entry errors.",
    "Review and correct category classification for this merchant.",
    "Monitor for potential duplicate transactions or subscription billing issues.",
    "Verify transaction timing and merchant legitimacy.",
    "Review transaction details and verify all information is correct.",
]
# Status per severity.
STATUS = {"high": "requires_attention", "medium": "review_recommended", "low": "monitor", "minimal": "acknowledged"}


def _stats(prefix: str) -> dict:
    """Mean, deviation and count of the last rows; the mean comes from an exact sum of cents."""

    def mean(w: WindowSpec) -> Column:
        return F.sum("_cents").over(w).cast("double") / 100 / F.count("*").over(w)

    return {
        f"{prefix}_avg_amount_30d": mean,
        f"{prefix}_std_amount_30d": lambda w: F.stddev_samp("_abs").over(w),
        f"{prefix}_transaction_count_30d": lambda w: F.count("*").over(w),
    }


def _row_flags() -> dict[str, Column]:
    """Flags that need no statistics."""
    category, merchant = F.col("category_std"), F.lower("merchant_clean")
    mismatch = F.lit(False)
    for word, fitting in EXPECTED_CATEGORIES:
        mismatch = mismatch | (merchant.contains(word) & ~category.isin(*fitting))
    return {
        "is_unusual_timing": F.dayofweek("posted_at").isin(1, 7) & category.isin(*WEEKDAY_CATEGORIES),
        "is_category_mismatch": mismatch,
    }


def rolling_statistics(
    stg: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Expenses with the statistics of the last 30 rows of their category and merchant, and their distance from them."""
    spent = F.abs("amount_usd")
    base = stg.filter("is_expense").select(
        "txn_id",
        "merchant_clean",
        "category_std",
        "account_id",
        "amount_usd",
        "posted_at",
        num(spent).alias("_abs"),
        (spent * 100).cast("long").alias("_cents"),
    )
    skew = find_skew(base, ["category_std", "merchant_clean"], "posted_at", max_group_rows)
    if any(s.days is not None for s in skew.values()):
        base = settle(base, "expenses")
    rows = base
    for prefix, key in (("category", "category_std"), ("merchant", "merchant_clean")):
        rows = rolling_rows(
            rows, key, "posted_at", "txn_id", ROWS_BACK, _stats(prefix), skew[key], block_rows=block_rows
        )
        mean, std = F.col(f"{prefix}_avg_amount_30d"), F.col(f"{prefix}_std_amount_30d")
        rows = rows.withColumns(
            {
                f"{prefix}_z_score": F.coalesce((F.col("_abs") - mean) / F.nullif(std, F.lit(0.0)), F.lit(0.0)),
                f"{prefix}_amount_ratio": F.coalesce(F.col("_abs") / F.nullif(mean, F.lit(0.0)), F.lit(1.0)),
                **(_row_flags() if prefix == "category" else {}),
            }
        )
    return rows


def _first_of(*conditions: Column) -> Column:
    """Index of the first true condition, or their number."""
    index = F.lit(len(conditions))
    for i, condition in reversed(list(enumerate(conditions))):
        index = F.when(condition, F.lit(i)).otherwise(index)
    return index


def _pick(rows: Sequence[tuple], names: Sequence[str], index: Column) -> Column:
    """The struct of texts at an index."""
    return F.get(F.array(*[F.struct(*[F.lit(t).alias(n) for t, n in zip(row, names)]) for row in rows]), index)


def anomaly_score(
    stg: DataFrame,
    threshold: float = ANOMALY_THRESHOLD,
    max_group_rows: int = MAX_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Expenses whose composite score reaches the threshold.

    Texts are looked up by index instead of long CASE expressions: the filter and
    the projections after the windows compile into one method, and the JVM does
    not optimise methods beyond 8000 bytes.
    """
    rows = rolling_statistics(stg, max_group_rows, block_rows)
    count = F.col("merchant_transaction_count_30d")
    z_category, z_merchant = F.abs("category_z_score"), F.abs("merchant_z_score")
    rows = rows.withColumns(
        {
            "is_statistical_outlier": F.greatest(z_category, z_merchant) > 2,
            "is_amount_spike": F.greatest("category_amount_ratio", "merchant_amount_ratio") > 3,
            "is_novel_merchant": count == 1,
            "is_high_frequency": count > 10,
        }
    )
    score = F.least(z_category * Z_POINTS, F.lit(float(Z_LIMIT))) + F.least(z_merchant * Z_POINTS, F.lit(float(Z_LIMIT)))
    flags = F.lit(0)
    for flag, points in POINTS.items():
        flags = flags + F.col(flag).cast("int") * points
    score = F.least(flags + score, F.lit(100.0))
    rows = rows.withColumn("anomaly_score", score).filter(F.col("anomaly_score") >= threshold)

    outlier, spike = F.col("is_statistical_outlier"), F.col("is_amount_spike")
    novel, timing = F.col("is_novel_merchant"), F.col("is_unusual_timing")
    frequent, wrong = F.col("is_high_frequency"), F.col("is_category_mismatch")
    kind = F.col("_kind")
    number = F.when(kind == 1, z_category).when(kind.isin(0, 2), F.col("category_amount_ratio"))
    levels = [*[name for _, name in SEVERITY], "minimal"]
    severity = _first_of(*[F.col("anomaly_score") >= least for least, _ in SEVERITY])
    rows = rows.withColumn("_kind", _first_of(outlier & spike, outlier, spike, novel, timing, frequent, wrong)).withColumns(
        {
            "_level": _pick([(n, STATUS[n]) for n in levels], ["severity", "status"], severity),
            "_text": _pick(TYPES, ["type", "head", "middle", "tail"], kind),
            "_hint": _pick([(h,) for h in HINTS], ["hint"], _first_of(outlier & spike, novel, wrong, frequent, timing)),
            "_first": F.when(kind == 5, count.cast("string")).otherwise(number.cast("decimal(18,1)").cast("string")),
            "_second": F.when(kind == 0, F.col("merchant_amount_ratio")).cast("decimal(18,1)").cast("string"),
        }
    )
    driver = F.concat_ws("", "_text.head", "_first", "_text.middle", "_second", "_text.tail")
    return rows.select(
        "txn_id",
        F.col("merchant_clean").alias("merchant_name"),
        F.col("category_std").alias("category_name"),
        "account_id",
        "amount_usd",
        "posted_at",
        F.to_date("posted_at").alias("transaction_date"),
        F.month("posted_at").alias("month"),
        F.year("posted_at").alias("year"),
        F.dayofweek("posted_at").alias("day_of_week"),
        "anomaly_score",
        "_level.severity",
        F.col("_text.type").alias("anomaly_type"),
        driver.alias("driver"),
        F.col("_hint.hint").alias("remediation_hint"),
        *POINTS,
        "category_z_score",
        "merchant_z_score",
        "category_amount_ratio",
        "merchant_amount_ratio",
        "category_avg_amount_30d",
        "category_std_amount_30d",
        "merchant_avg_amount_30d",
        "merchant_std_amount_30d",
        "merchant_transaction_count_30d",
        "category_transaction_count_30d",
        "_level.status",
        F.lit(False).alias("acknowledged"),
        F.lit(None).cast("timestamp_ntz").alias("acknowledged_at"),
        F.lit(None).cast("string").alias("acknowledged_by"),
    )


def acknowledge(anomalies: DataFrame, log: DataFrame) -> DataFrame:
    """Overlay the latest acknowledgement per transaction.

    ``log`` has txn_id, acknowledged, acknowledged_at, acknowledged_by.
    """
    latest = (
        log.groupBy("txn_id")
        .agg(
            F.max_by(
                F.struct("acknowledged", "acknowledged_at", "acknowledged_by"),
                F.struct("acknowledged_at", "acknowledged_by"),
            ).alias("_ack")
        )
        .withColumnRenamed("txn_id", "_ack_id")
    )
    joined = anomalies.join(latest, F.col("txn_id") == F.col("_ack_id"), "left")
    known = F.col("_ack").isNotNull()
    return joined.withColumns(
        {c: F.when(known, F.col(f"_ack.{c}")).otherwise(F.col(c)) for c in
         ("acknowledged", "acknowledged_at", "acknowledged_by")}
    ).drop("_ack", "_ack_id")


def category_fences(stg: DataFrame, factor: float = 1.5) -> DataFrame:
    """Exact quartiles of the expense per category and the fences around them.

    Equal amounts are counted first. The rank search is two-step, so no task
    sees all amounts of a category: cumulative counts over amount ranges find
    the range that holds a quartile position, and only that range is searched.
    """
    values = (
        stg.filter("is_expense")
        .groupBy("category_std", F.abs("amount_usd").alias("amount"))
        .agg(F.count("*").alias("n"))
        .withColumn("range", F.floor(F.col("amount") / 1000))
    )


    in_order = Window.partitionBy("category_std").orderBy("range")
    whole = Window.partitionBy("category_std")
    ranges = (
        values.groupBy("category_std", "range")
        .agg(F.sum("n").alias("range_n"))
        .withColumns(
            {
                "before": F.sum("range_n").over(in_order) - F.col("range_n"),
                "total": F.sum("range_n").over(whole),
            }
        )
    )
    positions = ranges.select(
        "*",
        F.explode(F.array(F.lit(0.25), F.lit(0.75))).alias("q"),
    ).withColumn("place", (F.col("total") - 1) * F.col("q"))
    targets = positions.select("*", F.explode(F.array(F.floor("place"), F.ceil("place"))).alias("rank")).filter(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("range_n"))
    )
    inside = Window.partitionBy("category_std", "range").orderBy("amount")
    placed = values.join(ranges, ["category_std", "range"]).withColumn(
        "end", F.col("before") + F.sum("n").over(inside)
    )
    placed = placed.withColumn("start", F.col("end") - F.col("n")).select(
        "category_std", "range", "amount", "start", "end"
    )
    wanted = targets.select("category_std", "range", "q", "place", "rank").distinct()
    found = wanted.join(placed, ["category_std", "range"]).filter(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end"))
    )
    low, high = num(F.min("amount")), num(F.max("amount"))
    fraction = F.first("place") - F.floor(F.first("place"))
    quartile = found.groupBy("category_std", "q").agg((low + (high - low) * fraction).alias("value"))
    return (
        quartile.groupBy("category_std")
        .agg(
            F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
        )
        .withColumns(
            {
                "lower_fence": F.col("q1") - factor * (F.col("q3") - F.col("q1")),
                "upper_fence": F.col("q3") + factor * (F.col("q3") - F.col("q1")),
            }
        )
    )


def anomaly_iqr(stg: DataFrame, factor: float = 1.5) -> DataFrame:
    """Expenses outside the interquartile fences of their category.

    The fences are written out first: as a file their size is known, so the join
    is a broadcast unless there are very many categories.
    """
    fences = settle(category_fences(stg, factor), "fences")
    spent = num(F.abs("amount_usd"))
    rows = stg.filter("is_expense").select("txn_id", "category_std", "amount_usd", spent.alias("spent"))
    return (
        rows.join(fences, "category_std")
        .filter((F.col("spent") < F.col("lower_fence")) | (F.col("spent") > F.col("upper_fence")))
        .select("txn_id", "category_std", "amount_usd", "q1", "q3", "lower_fence", "upper_fence")
    )
