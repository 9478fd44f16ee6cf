"""The split windows must equal the plain windows row for row."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows_of
from ledgermill.operators import anomalies, quality, staging
from ledgermill.operators.keyed_windows import PIECE, Skew, _pieces, find_skew, rolling_rows, running_total
from ledgermill.plans import derived


def skewed(spark, n=4000):
    """One key with a third of the rows, date-only and exact timestamps mixed, and a NULL key."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 101 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), i % 17))
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    micros = F.when(i % 2 == 0, 0).otherwise((i * 7919) % 86_400_000_000)
    return spark.range(n).select(
        key.alias("key"),
        (base + F.make_dt_interval(days=(i % 5).cast("int"), secs=micros.cast("decimal(18,6)") / 1_000_000)).alias("ts"),
        F.sha2(i.cast("string"), 256).alias("row_id"),
        ((i * 31) % 1009).cast("decimal(15,2)").alias("amount"),
    )


def with_nulls(spark, n=4000):
    """The same rows, some without timestamp, amount, id or key."""
    i = F.conv(F.substring("row_id", 1, 6), 16, 10).cast("int")
    void = {"ts": 11, "amount": 3, "key": 23}
    df = skewed(spark, n).withColumns({c: F.when(i % k != 0, F.col(c)) for c, k in void.items()})
    # one row of a timestamp may lack the id, so that the order stays unique
    first = F.row_number().over(Window.partitionBy("key", "ts").orderBy("row_id")) == 1
    return df.withColumn("row_id", F.when(~(first & (i % 2 == 0)), F.col("row_id")))


def outputs():
    return {
        "total": lambda w: F.sum("amount").over(w),
        "n": lambda w: F.count("*").over(w),
        "deviation": lambda w: F.stddev_samp(F.col("amount").cast("double")).over(w),
    }


@pytest.mark.parametrize("make", [skewed, with_nulls])
@pytest.mark.parametrize("limit,block", [(500, 29), (500, 100), (50, 64), (1, 30)])
def test_rolling_rows_equals_plain_window(spark, limit, block, make):
    df = make(spark)
    window = Window.partitionBy("key").orderBy("ts", "row_id").rowsBetween(-29, 0)
    plain = df.withColumns({k: of(window) for k, of in outputs().items()})
    split = rolling_rows(df, "key", "ts", "row_id", 29, outputs(), max_group_rows=limit, block_rows=block)
    assert rows_of(split) == rows_of(plain)


@pytest.mark.parametrize("make", [skewed, with_nulls])
@pytest.mark.parametrize("limit", [1, 50, 500])
def test_running_total_equals_plain_window(spark, limit, make):
    df = make(spark)
    window = Window.partitionBy("key").orderBy("ts", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("total", F.sum("amount").over(window))
    split = running_total(df, "key", "ts", "row_id", "amount", "total", max_group_rows=limit)
    assert rows_of(split) == rows_of(plain)


def test_hot_keys_are_the_large_ones(spark):
    df = skewed(spark)
    hot = find_skew(df, ["key"], "ts", 500)["key"]
    assert {r["_key"] for r in hot.days.collect()} == {"hot"} and not hot.dense
    assert find_skew(df, ["key"], "ts", 4000) == {"key": Skew()}
    assert find_skew(df, ["key"], "ts", 100)["key"].dense


def test_dense_days_are_cut_within_the_day(spark):
    """With a limit below a day's rows, pieces are smaller than the day even where all timestamps are equal."""
    hot = skewed(spark).filter("key = 'hot'")
    whole = _pieces(hot, "key", "ts", "row_id", find_skew(hot, ["key"], "ts", 500)["key"])
    assert whole.groupBy(*PIECE).count().count() == hot.select(F.to_date("ts")).distinct().count()
    cut = _pieces(hot, "key", "ts", "row_id", find_skew(hot, ["key"], "ts", 50)["key"])
    assert cut.groupBy(*PIECE).count().agg(F.max("count")).first()[0] < 20


def scans(df):
    """Table reads in the plan, by name of the leaves."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def test_split_plan_reads_little(spark, small):
    stg = derived.staged(spark, small)
    assert scans(anomalies.anomaly_score(stg, max_group_rows=20, block_rows=40)) <= 4
    ledger = staging.running_balance(derived.raw_ledger(spark, small), 10000, max_group_rows=5)
    assert scans(ledger) <= 4


def test_scores_do_not_depend_on_the_split(spark, small):
    stg = derived.staged(spark, small)
    columns = ["txn_id", "anomaly_score", "severity", "driver", "category_z_score", "merchant_std_amount_30d"]
    plain = anomalies.anomaly_score(stg)
    split = anomalies.anomaly_score(stg, max_group_rows=20, block_rows=40)
    assert rows_of(split, *columns) == rows_of(plain, *columns)


def test_running_balance_does_not_depend_on_the_split(spark, small):
    raw = derived.raw_ledger(spark, small)
    plain = staging.running_balance(raw, 10000)
    split = staging.running_balance(raw, 10000, max_group_rows=5)
    assert rows_of(split, "txn_id", "balance_after") == rows_of(plain, "txn_id", "balance_after")


def test_balance_breaks(spark, small):
    ledger = derived.ledger(spark, small)
    assert quality.balance_breaks(ledger).count() == 0
    assert quality.balance_breaks(ledger, max_group_rows=5, block_rows=7).count() == 0
    one = ledger.orderBy("posted_at", "txn_id").first()["txn_id"]
    broken = ledger.withColumn(
        "balance_after", F.when(F.col("txn_id") == one, F.col("balance_after") + 1).otherwise(F.col("balance_after"))
    )
    assert quality.balance_breaks(broken).count() == 1
