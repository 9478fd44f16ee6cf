"""Small ledgers with results worked out by hand, and invariants over the derived ledger."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from ledgermill.operators import anomalies, budget, cashflow, forecasts, networth, quality, recurring, simple_marts, staging
from ledgermill.operators.materialize import VersionedTable, export_parquet, newer_rows, register_views, upsert
from ledgermill.plans import derived, reports
from ledgermill.reference_data import categories, local_rows
from ledgermill.schemas import FX_RATE

STG = (
    "txn_id string, source string, account_id string, posted_at timestamp_ntz, currency string, amount decimal(15,2), "
    "amount_usd decimal(15,2), month string, merchant_clean string, category_std string, balance_after decimal(18,2), "
    "is_income boolean, is_expense boolean, is_transfer boolean, is_investment boolean"
)


def stage_rows(spark, rows):
    """rows: (when, amount, merchant, category[, account[, source[, balance[, currency]]]])"""
    out = []
    for i, row in enumerate(rows):
        when, amount, merchant, category, *rest = row
        account, source, balance, currency = [*rest, *["acct", "bank", None, "USD"][len(rest) :]]
        value = Decimal(str(amount)).quantize(Decimal("0.01"))
        balance = None if balance is None else Decimal(str(balance))
        out.append(
            (f"{i:064x}", source, account, when, currency, value, value, f"{when:%Y-%m}", merchant, category, balance,
             amount > 0, amount < 0, False, False)
        )
    return spark.createDataFrame(out, STG)


def at(text):
    return datetime.fromisoformat(text)


# --- recurring ----------------------------------------------------------------


@pytest.mark.parametrize(
    "gaps,amounts,kind",
    [
        ([30, 30, 30], [10, 10, 10, 10], "monthly"),
        ([25, 25], [10, 10, 10], "monthly"),
        ([35, 35], [10, 10, 10], "monthly"),
        ([36, 36], [10, 10, 10], None),
        ([7, 7, 7], [10, 10, 10, 10], "weekly"),
        ([90, 90], [10, 10, 10], "quarterly"),
        ([365, 365], [10, 10, 10], "yearly"),
        ([30, 30, 30], [10, 15, 10, 15], "likely_monthly"),
        ([7, 7, 7], [10, 15, 10, 15], "likely_weekly"),
        ([30, 30, 30], [10, 30, 10, 30], None),
        ([30], [10, 10], None),
    ],
)
def test_recurring_classes(spark, gaps, amounts, kind):
    days = [at("2023-01-05")]
    for gap in gaps:
        days.append(days[-1] + timedelta(days=gap))
    stg = stage_rows(spark, [(d, -a, "Gym", "Health") for d, a in zip(days, amounts)])
    rows = recurring.recurring(stg, date(2023, 2, 1)).collect()
    assert [r["recurring_type"] for r in rows] == ([kind] if kind else [])
    if rows:
        assert rows[0]["total_transactions"] == len(days)
        assert rows[0]["first_transaction_date"] == days[0].date()
        assert rows[0]["last_transaction_date"] == days[-1].date()


def test_recurring_statistics_count_same_day_repeats(spark):
    stg = stage_rows(spark, [(at(f"2023-01-{d:02d}"), -a, "Gym", "Health") for d, a in ((1, 5), (1, 7), (8, 5), (15, 9))])
    row = recurring.payment_statistics(stg).first()
    assert row["total_transactions"] == 4
    assert row["avg_interval_days"] == pytest.approx(14 / 3)
    assert row["interval_stddev"] == pytest.approx((((0 - 14 / 3) ** 2 + 2 * (7 - 14 / 3) ** 2) / 2) ** 0.5)
    assert row["avg_amount"] == pytest.approx(6.5)
    assert row["amount_stddev"] == pytest.approx((11 / 3) ** 0.5)


def test_recurring_status_and_two_categories(spark):
    days = [at("2023-01-05") + timedelta(days=30 * k) for k in range(4)]
    rows = [(d, -10, "Gym", "Health" if k % 2 else "Sport") for k, d in enumerate(days)]
    got = {
        as_of: {r["category_name"]: r["status"] for r in recurring.recurring(stage_rows(spark, rows), as_of).collect()}
        for as_of in (date(2023, 5, 10), date(2023, 5, 1), date(2023, 4, 20), date(2023, 3, 1))
    }
    # last payments: Health 2023-04-05 (due 05-05), Sport 2023-03-06 (due 04-06)
    assert got[date(2023, 5, 10)] == {"Health": "overdue", "Sport": "overdue"}
    assert got[date(2023, 5, 1)] == {"Health": "due_soon", "Sport": "overdue"}
    assert got[date(2023, 4, 20)] == {"Health": "upcoming", "Sport": "overdue"}
    assert got[date(2023, 3, 1)] == {"Health": "future", "Sport": "future"}


# --- anomalies ----------------------------------------------------------------


def scores(spark, rows):
    found = anomalies.anomaly_score(stage_rows(spark, rows), threshold=0).orderBy("posted_at", "txn_id").collect()
    return found


def test_first_rows_have_no_deviation(spark):
    rows = scores(spark, [(at("2024-01-03"), -10, "Cafe", "Food & Dining")])
    assert rows[0]["category_z_score"] == 0 and rows[0]["category_amount_ratio"] == 1
    assert rows[0]["is_novel_merchant"] and rows[0]["anomaly_score"] == 15
    assert rows[0]["anomaly_type"] == "Novel Merchant" and rows[0]["severity"] == "minimal"


def test_outlier_and_spike(spark):
    steady = [(at(f"2024-01-{d:02d}"), -10 - d % 2, "Cafe", "Food & Dining") for d in range(1, 20)]
    row = scores(spark, [*steady, (at("2024-01-31"), -500, "Cafe", "Food & Dining")])[-1]
    assert row["is_statistical_outlier"] and row["is_amount_spike"] and row["is_high_frequency"]
    assert row["anomaly_type"] == "Statistical Outlier + Amount Spike"
    assert row["driver"] == "Transaction amount is 14.3x the category average and 14.3x the merchant average"
    assert row["anomaly_score"] == 25 + 20 + 15 + 15 + 15 and row["severity"] == "high"
    assert row["status"] == "requires_attention"


def test_weekend_frequency_and_mismatch(spark):
    sunday = at("2024-01-07")
    rows = scores(spark, [(sunday, -10, "Consult", "Professional Services"), (sunday, -10, "Corner Restaurant", "Other")])
    assert rows[0]["is_unusual_timing"] and not rows[1]["is_unusual_timing"]
    assert rows[1]["is_category_mismatch"] and not rows[0]["is_category_mismatch"]
    many = scores(spark, [(at(f"2024-01-{d:02d}"), -10, "Gas Stop", "Gas") for d in range(1, 13)])
    assert [r["is_high_frequency"] for r in many] == [False] * 10 + [True] * 2
    assert many[-1]["driver"] == "High frequency of transactions with this merchant (12 in 30 days)"
    assert not any(r["is_category_mismatch"] for r in many)


def test_score_bounds_and_threshold(spark, small):
    every = anomalies.anomaly_score(derived.event_spend(spark, small), threshold=0)
    low, high, n = every.agg(F.min("anomaly_score"), F.max("anomaly_score"), F.count("*")).first()
    assert 0 <= low and high <= 100 and n == derived.read(spark, small, "events").count()
    kept = anomalies.anomaly_score(derived.event_spend(spark, small))
    assert kept.count() == every.filter("anomaly_score >= 20").count()


def test_latest_acknowledgement_wins(spark):
    stg = stage_rows(spark, [(at("2024-01-03"), -10, "Cafe", "X"), (at("2024-01-04"), -10, "Bar", "Y")])
    rows = anomalies.anomaly_score(stg, threshold=0)
    first = f"{0:064x}"
    log = spark.createDataFrame(
        [(first, True, at("2024-02-01"), "ann"), (first, False, at("2024-02-03"), "bob"), (first, True, at("2024-02-02"), "cy")],
        "txn_id string, acknowledged boolean, acknowledged_at timestamp_ntz, acknowledged_by string",
    )
    got = rows_of(anomalies.acknowledge(rows, log), "txn_id", "acknowledged", "acknowledged_by")
    assert got == [(first, False, "bob"), (f"{1:064x}", False, None)]


def test_quartiles_match_sorted_values(spark):
    amounts = [1, 2, 2, 3, 1500, 1501, 2500.5, 9000, 9000, 12345]
    stg = stage_rows(spark, [(at("2024-01-03"), -a, "m", "c") for a in amounts])
    row = anomalies.category_fences(stg).first()
    assert (row["q1"], row["q3"]) == (2.25, 7375.125)


# --- novel merchants: reduced form against the definition -----------------------


def test_novel_merchants_equal_the_definition(spark, small):
    simple = staging.simple_view(derived.staged(spark, small))
    t, e = simple.alias("t"), simple.alias("e")
    seen = (
        (F.col("t.merchant_norm") == F.col("e.merchant_norm"))
        & (F.col("e.posted_at") < F.col("t.posted_at"))
        & (F.col("e.posted_at") >= F.col("t.posted_at") - F.expr("INTERVAL '90' DAY"))
    )
    expected = t.join(e, seen, "left_anti").select("t.txn_id")
    assert rows_of(simple_marts.novel_merchant_90d(simple), "txn_id") == rows_of(expected)


# --- forecasts ------------------------------------------------------------------


def test_forecast_by_hand(spark):
    rows = [(at(f"2024-{m:02d}-10"), -a, "m", "Food") for m, a in ((1, 100), (2, 110), (3, 121))]
    got = {r["forecast_horizon"]: r for r in forecasts.forecast(stage_rows(spark, rows), date(2024, 3, 31))
           .filter("category_name = 'Food'").collect()}
    mean = (100 + 110 + 121) / 3
    assert got["1_month"]["forecast_amount"] == pytest.approx(mean * 1.1)
    assert got["3_months"]["forecast_amount"] == pytest.approx(mean * 1.1**3)
    assert got["1_month"]["forecast_date"] == date(2024, 4, 1)
    # trend exactly at the limit 0.1 is not below it; volatility of (0, .1, .1) is small
    assert got["1_month"]["confidence_level"] == pytest.approx(0.70)
    assert got["2_months"]["confidence_level"] == pytest.approx(0.63)
    assert got["1_month"]["lower_bound"] == pytest.approx(mean * 1.1 * 0.3)


def test_one_month_series_has_lowest_confidence(spark):
    row = forecasts.forecast(stage_rows(spark, [(at("2024-03-01"), -50, "m", "Food")]), date(2024, 3, 31))
    row = row.filter("category_name = 'Food' AND forecast_horizon = '1_month'").first()
    assert row["forecast_amount"] == 50 and row["confidence_level"] == 0.40 and row["risk_level"] == "very_high_risk"


def test_previous_zero_gives_no_trend(spark):
    rows = [(at("2024-01-01"), 10, "m", "Food"), (at("2024-02-01"), -50, "m", "Food")]
    row = forecasts.forecast(stage_rows(spark, rows), date(2024, 3, 1)).filter("category_name = 'Food'").first()
    assert row["volatility"] == 0 and row["forecast_amount"] == 25


# --- cashflow, net worth, budget: invariants --------------------------------------


def test_cashflow_invariants(spark, small):
    stg = derived.staged(spark, small, with_balance=True)
    daily = cashflow.cashflow_daily(stg)
    monthly = cashflow.cashflow_monthly(daily)
    total = stg.agg(F.sum("amount_usd")).first()[0]
    assert daily.agg(F.sum("net_amount")).first()[0] == total == monthly.agg(F.sum("net_amount")).first()[0]
    flows = F.col("income") - F.col("expenses") + F.col("transfers") + F.col("investments")
    assert daily.filter(flows != F.col("net_amount")).count() == 0
    assert monthly.filter(F.col("active_days") > 31).count() == 0


def test_monthly_keeps_years_apart(spark):
    stg = stage_rows(spark, [(at(f"{y}-05-01"), a, "m", "c") for y, a in ((2023, 100), (2024, 150))])
    got = rows_of(cashflow.cashflow_monthly(cashflow.cashflow_daily(stg)), "month", "income", "income_mom_change")
    assert got == [("2023-05", Decimal("100.00"), None), ("2024-05", Decimal("150.00"), 50.0)]


def test_net_worth_counts_each_account_once(spark):
    fx = local_rows(spark, [(date(2024, 1, 1), Decimal("0.5"), Decimal("0.8"), Decimal("1.3"), Decimal("1.5"))], FX_RATE)
    stg = stage_rows(
        spark,
        [
            (at("2024-01-01T09:00"), 10, "m", "c", "bank_checking_1", "bank", 100),
            (at("2024-01-01T10:00"), 10, "m", "c", "bank_checking_1", "bank", 110),
            (at("2024-01-01T11:00"), 10, "m", "c", "bank_savings_1", "bank", 50, "EUR"),
            (at("2024-01-01T12:00"), -5, "m", "c", "card_1", "card", -30),
            (at("2024-01-02T12:00"), -5, "m", "c", "bank_savings_1", "bank", 45, "EUR"),
        ],
    )
    first, second = networth.net_worth(stg, fx).orderBy("date").collect()
    assert first["total_assets"] == 110 + 100 and first["total_liabilities"] == 30 and first["net_worth"] == 180
    assert (first["asset_accounts"], first["liability_accounts"], first["total_accounts"]) == (2, 1, 3)
    assert first["opening_assets"] == 200 and second["net_worth"] == 45  # no rate: counts as 1
    assert second["net_worth_dod_change"] == -135 and second["net_worth_dod_change_pct"] == -75


def test_budget_status_bands(spark):
    stg = stage_rows(
        spark,
        [(at("2024-01-01"), -a, "m", c) for c, a in (("Groceries", 330), ("Utilities", 134), ("Clothing", 111), ("Pets", 50))],
    )
    got = rows_of(budget.budget_vs_actual(stg), "category_name", "budget_status", "variance")
    assert got == [
        ("Clothing", "over_budget", Decimal("11.00")),
        ("Groceries", "on_budget", Decimal("30.00")),
        ("Pets", "on_budget", Decimal("0.00")),
        ("Utilities", "under_budget", Decimal("-16.00")),
    ]
    with_table = budget.budget_vs_actual(stg, budget.targets(stg))
    assert rows_of(with_table, "category_name", "budget_status", "variance") == got


def test_staging_rules(spark, small):
    stg = derived.staged(spark, small)
    pays = stg.filter("merchant_raw = 'CREDIT CARD PAYMENT'").first()
    assert pays["category_std"] == "Debt Payment" and pays["is_transfer"] and not pays["is_expense"]
    corner = rows_of(stg.filter("merchant_raw = 'Corner Restaurant'").select("category_std").distinct())
    assert corner == [("Other",), ("Restaurants",)]
    raw = spark.createDataFrame(
        [("CREDIT CARD PAYMENT", None), ("  unknown shop ", "Gas"), (None, "No Such")], "merchant_raw string, category_raw string"
    )
    got = staging.normalise_merchants(raw, categories(spark)).select("merchant_clean", "category_std").collect()
    assert sorted(map(tuple, got)) == [("", "Other"), ("Payment", "Transfers"), ("unknown shop", "Gas")]


# --- reports --------------------------------------------------------------------


def test_kpis_follow_the_account(spark, small):
    monthly = cashflow.cashflow_monthly(cashflow.cashflow_daily(derived.staged(spark, small, with_balance=True)))
    every = {r["metric_name"]: r["value"] for r in reports.kpis(monthly, "2000-05").collect()}
    accounts = [r[0] for r in monthly.filter("month = '2000-05'").select("account_id").distinct().collect()]
    one = [reports.kpis(monthly, "2000-05", a).filter("metric_name = 'Total Expenses'").first()["value"] for a in accounts[:3]]
    assert sum(one) <= every["Total Expenses"]
    assert every["Net Cash Flow"] == pytest.approx(every["Total Income"] - every["Total Expenses"])


def test_weekly_equals_daily_totals(spark, small):
    daily = cashflow.cashflow_daily(derived.staged(spark, small, with_balance=True))
    rows = reports.cashflow(daily, date(2001, 8, 2), "month", 3)
    totals = reports.cashflow_totals(rows).first()
    assert totals["total_income"] == rows.agg(F.sum("income")).first()[0]


# --- materialisation --------------------------------------------------------------


def test_upsert_is_idempotent_and_adds_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B", True), (3, "c", True), (None, "N", True)], "k int, v string, fresh boolean")
    once = upsert(old, new, ["k"])
    assert rows_of(once, "k", "v", "fresh") == sorted(
        [(1, "a", None), (2, "B", True), (3, "c", True), (None, "N", True)], key=repr
    )
    assert rows_of(upsert(once, new, ["k"])) == rows_of(once)


def test_versioned_table(spark, folder):
    table = VersionedTable(spark, f"{folder}/mart")
    assert not table.exists()
    table.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    table.replace(upsert(table.read(), spark.createDataFrame([(2, "c")], "k int, v string"), ["k"]))
    assert rows_of(table.read(), "k", "v") == [(1, "a"), (2, "c")]
    (open(f"{folder}/mart/v00000002/_SUCCESS").close())
    import os

    os.makedirs(f"{folder}/mart/v00000003")  # a job that died half-way
    assert rows_of(table.read(), "k", "v") == [(1, "a"), (2, "c")]
    assert table.replace(spark.createDataFrame([(3, "d")], "k int, v string")) == 4


def test_rolling_means_have_no_end(spark):
    """Levels of 9e15 a day over many days: sums beyond a LONG of cents."""
    from ledgermill.operators.exprs import rolling_means

    days = spark.range(200).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("9000000000000000.25").cast("decimal(18,2)").alias("x"),
    )
    rows = rolling_means(days, [], "date", ["x"], [7, 90], "d").collect()
    assert {r["x_7d_avg"] for r in rows} == {9000000000000000.25} == {r["x_90d_avg"] for r in rows}


def test_high_watermark(spark):
    source = spark.createDataFrame([("2024-01",), ("2024-02",)], "month string")
    target = source.filter("month = '2024-01'")
    assert rows_of(newer_rows(source, target, "month")) == [("2024-02",)]
    assert newer_rows(source, target.limit(0), "month").count() == 2


def test_export_layouts(spark, small, folder):
    simple = staging.simple_view(derived.staged(spark, small))
    monthly = simple_marts.mart_cashflow_monthly(simple)
    assert export_parquet(monthly, f"{folder}/m") == ["part_year", "part_month"]
    pairs = simple_marts.mart_recurring(simple, date(2001, 8, 2)).drop("month")
    assert export_parquet(pairs, f"{folder}/r") == []
    register_views(spark, {"stored_monthly": f"{folder}/m"})
    back = spark.sql("SELECT COUNT(*) AS n, MAX(part_month) AS m FROM stored_monthly WHERE part_year = 2000").first()
    assert (back["n"], back["m"]) == (12, 12)


# --- quality ----------------------------------------------------------------------


def test_checks_count_each_kind(spark):
    df = spark.createDataFrame(
        [("a", 5.0, "USD"), ("a", -1.0, "usd"), (None, None, "EUR"), ("b", 0.0, None)], "k string, x double, c string"
    )
    checks = [
        quality.not_null("k"),
        quality.unique("k"),
        quality.in_range("x", 0, 4),
        quality.accepted("c", ["USD", "EUR"]),
        quality.matches("c", quality.CURRENCY_CODE),
        quality.non_zero("x"),
    ]
    got = rows_of(quality.run_suite(df, "t", checks), "check", "column", "checked", "failed", "passed")
    assert got == [
        ("accepted_values", "c", 4, 1, False),
        ("non_zero", "x", 4, 1, False),
        ("not_null", "k", 4, 1, False),
        ("range", "x", 4, 2, False),
        ("regex", "c", 4, 1, False),
        ("unique", "k", 3, 2, False),
    ]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert quality.orphans(child, parent, "fk", "pk").count() == 1
    row = quality.foreign_key(child, parent, "t", "fk", "pk").first()
    assert (row["checked"], row["failed"]) == (4, 1)


def test_schema_checks(spark):
    from ledgermill.operators import contract

    df = spark.createDataFrame([(Decimal("1.00"), "a")], "amount decimal(15,2), k string")
    assert contract.same_order(df.columns, ["amount", "k"]) and not contract.same_order(df.columns, ["k", "amount"])
    assert contract.has_columns(df.columns, ["k"]) and not contract.has_columns(df.columns, ["x"])
    assert contract.has_type(df, "amount", ("integer", "double", "decimal")) and not contract.has_type(df, "k", ("double",))
    counted = quality.score(quality.row_count_between(df, "t", 2, 5)).first()
    assert not counted["passed"] and counted["checked"] == 1


def test_quality_results_become_metric_points(spark):
    from ledgermill.operators import metrics

    df = spark.createDataFrame([("a",), (None,)], "k string")
    points = metrics.quality_points(quality.run_suite(df, "t", [quality.not_null("k")]), at("2024-01-01"))
    got = rows_of(points, "name", "value", "unit")
    assert got == [
        ("data_quality_failed_rows", 1.0, "rows"),
        ("data_quality_rows_checked", 2.0, "rows"),
        ("data_quality_score", 50.0, "%"),
    ]
    recent = metrics.select_metrics(points, "data_quality_score", at("2024-01-01"), at("2024-01-02"))
    assert metrics.metric_summary(recent).first()["latest"] == 50.0
    assert metrics.select_metrics(points, end=at("2023-01-01")).count() == 0
    rate = spark.range(1).select(metrics.throughput(F.lit(500), F.lit(250)).alias("r"), metrics.throughput(F.lit(5), F.lit(0)).alias("z"))
    assert tuple(rate.first()) == (2000.0, 0.0)


def test_json_and_csv_exports(spark, folder):
    from ledgermill.operators.materialize import export_csv, export_json

    df = spark.createDataFrame([(1, at("2024-01-02T03:04:05"))], "k int, t timestamp_ntz")
    export_json(df, f"{folder}/j")
    export_csv(df, f"{folder}/c")
    assert spark.read.text(f"{folder}/j").first()[0] == '{"k":1,"t":"2024-01-02T03:04:05.000"}'
    assert spark.read.csv(f"{folder}/c", header=True).columns == ["k", "t"]


def test_audit_trail_of_one_user(spark):
    from ledgermill.operators import privacy

    events = spark.createDataFrame(
        [("u1", "read", True, at("2024-01-01")), ("u1", "read", False, at("2024-01-02")), ("u2", "write", True, at("2024-01-03"))],
        "user_id string, action string, success boolean, timestamp timestamp_ntz",
    )
    got = rows_of(privacy.audit_counts(privacy.audit_trail(events, "u1")), "user_id", "action", "events", "succeeded", "failed")
    assert got == [("u1", "read", 2, 1, 1)]


def test_unique_failures_compare_whole_keys(spark):
    from ledgermill.operators.quality import unique_failures

    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "a"), (None, "a"), (3, None), (4, "b")], "k int, t string")
    got = {r.column: (r.checked, r.failed) for r in unique_failures(df, "t", [["k"], ["k", "t"], ["t"]]).collect()}
    assert got == {"k": (5, 2), "k,t": (4, 2), "t": (6, 5)}
    clean = unique_failures(df.filter("k > 1"), "t", [["k"]])
    assert [tuple(r) for r in clean.collect()] == [("t", "unique", "k", 3, 0)]
    assert unique_failures(df.limit(0), "t", [["k"]]).first().checked == 0


def test_recent_rows_of_a_stored_mart(spark, folder):
    from ledgermill.operators.materialize import export_parquet, stored_months
    from ledgermill.plans import reports

    days = spark.range(400).select(
        F.col("id").cast("string").alias("txn_id"), F.lit("x").alias("anomaly_type"), F.when(F.col("id") % 4 == 0, "high").otherwise("low").alias("severity"),
        F.lit("d").alias("driver"), F.lit("h").alias("remediation_hint"), F.lit(False).alias("acknowledged"),
        F.when(F.col("id") % 50 != 7, F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int"))).alias("transaction_date"),
    ).withColumn("posted_at", F.col("transaction_date").cast("timestamp_ntz"))
    export_parquet(days, f"{folder}/m")
    months = stored_months(spark, f"{folder}/m")
    assert len(months) == 15 and months[0].endswith("part_year=2024/part_month=2") and "HIVE_DEFAULT" in months[-1]
    for limit, severity in ((3, None), (60, "high"), (10_000, None)):
        got = reports.anomalies_recent_stored(spark, f"{folder}/m", limit, severity)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in reports.anomalies_recent(days, limit, severity).collect()]
        if limit == 3:
            assert len(got.inputFiles()) == 1
    days.write.parquet(f"{folder}/whole")
    assert reports.anomalies_recent_stored(spark, f"{folder}/whole", 3).count() == 3
