"""Every query by name: ``(spark, sf_dir) -> DataFrame`` over the given tables.

Results are shaped for comparison with SQL: money as DOUBLE, and statistics whose
last digits depend on the order of summation rounded to four decimals.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import clean, hashing, pii
from ledgermill.operators import (
    anomalies,
    budget,
    cashflow,
    contract,
    forecasts,
    materialize,
    metrics,
    networth,
    privacy,
    quality,
    recurring,
    simple_marts,
    staging,
)
from ledgermill.plans import derived, reports
from ledgermill.reference_data import simple_categories
from ledgermill.schemas import MERCHANT_RULE
from ledgermill.session import run_dir, settle
from ledgermill.sources import exports
from ledgermill.streaming import compaction
from ledgermill.streaming import ingest as stream_ingest
from ledgermill.streaming import metrics as stream_metrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = derived.LEDGER_AS_OF
PERIOD = "2001-06"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shape(df: DataFrame, rounded: Sequence[str] = (), places: int = 4) -> DataFrame:
    out: list[Column] = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        if field.name in rounded:
            # half up by plain arithmetic, which every engine does alike
            c = F.floor(c * 10**places + 0.5) / 10**places
        out.append(c.alias(field.name))
    return df.select(*out)


def _simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.simple_view(derived.staged(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cashflow.cashflow_daily(derived.staged(spark, sf_dir, with_balance=True))


def _stored(spark: SparkSession, sf_dir: str, with_balance: bool = True) -> DataFrame:
    """The staged ledger as a table, for queries that read it more than once."""
    return settle(derived.staged(spark, sf_dir, with_balance=with_balance), "staged")


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cashflow.cashflow_monthly(_daily(spark, sf_dir))


def _budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.budget_vs_actual(derived.staged(spark, sf_dir))


def _net_worth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return networth.net_worth(derived.staged(spark, sf_dir, with_balance=True), derived.fx_rates(spark, sf_dir))


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.anomaly_score(derived.staged(spark, sf_dir))


def _forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasts.forecast(derived.staged(spark, sf_dir), AS_OF)


def _recurring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurring.recurring(derived.recurring_ledger(spark, sf_dir), derived.RECUR_AS_OF)


# --- ingest -----------------------------------------------------------------


def _raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the texts an export could hold."""
    o = derived.read(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    k = F.col("o_orderkey")
    grouped = F.format_number("o_totalprice", 2)
    amount = (
        F.when(k % 7 == 0, F.concat(F.lit("$"), grouped))
        .when(k % 7 == 1, price)
        .when(k % 7 == 2, F.concat(F.lit("-"), price))
        .when(k % 7 == 3, "")
        .when(k % 7 == 4, "n/a")
        .when(k % 7 == 5, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" $ "), grouped, F.lit(" ")))
    )
    d = F.col("o_orderdate")
    when = (
        F.when(k % 6 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k % 6 == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(k % 6 == 2, F.date_format(d, "dd/MM/yyyy"))
        .when(k % 6 == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(k % 12 == 4, "not a date")
        .when(k % 12 == 10, F.date_format(d, "yyyyMMdd"))
        .when(k % 12 == 5, F.date_format(d, "MMM d, yyyy"))
    )
    spellings = ["usd", " US ", "Dollar", "€", "euro", "UK", "chf"]
    currency = F.lit(None).cast("string")
    for i, text in enumerate(spellings):
        currency = F.when(k % 8 == i, text).otherwise(currency)
    return o.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
        amount.alias("amount_text"),
        when.alias("date_text"),
        currency.alias("currency_text"),
        (F.col("o_custkey") % 2 == 0).alias("is_credit"),
    )


@query
def std_amount(spark, sf_dir):
    rows = _raw_texts(spark, sf_dir)
    amount = clean.std_amount(F.col("amount_text"), F.col("is_credit"))
    return shape(rows.select("o_orderkey", "amount_text", "is_credit", amount.alias("amount")))


@query
def std_date(spark, sf_dir):
    rows = _raw_texts(spark, sf_dir)
    return rows.select("o_orderkey", "date_text", clean.std_date(F.col("date_text")).alias("posted_at"))


@query
def std_currency(spark, sf_dir):
    rows = _raw_texts(spark, sf_dir)
    return rows.select("o_orderkey", clean.std_currency(F.col("currency_text")).alias("currency"))


@query
def detect_channel(spark, sf_dir):
    """Channel of every document text."""
    docs = derived.read(spark, sf_dir, "documents")
    return docs.select("doc_id", clean.detect_channel(F.col("text")).alias("channel"))


@query
def txn_id_hash(spark, sf_dir):
    raw = derived.raw_ledger(spark, sf_dir)
    made = hashing.txn_id(
        F.col("posted_at"), F.col("amount"), F.col("merchant_raw"), F.col("description_raw"), F.col("source")
    )
    return raw.select("txn_id", made.alias("made_id"))


@query
def row_hash(spark, sf_dir):
    return derived.raw_ledger(spark, sf_dir).select("txn_id", "hash_raw")


@query
def ingest_valid(spark, sf_dir):
    """Rows per outcome of the date and amount rules."""
    rows = _raw_texts(spark, sf_dir)
    amount, posted = clean.std_amount(F.col("amount_text"), F.col("is_credit")), clean.std_date(F.col("date_text"))
    parsed = clean.parse_amount(F.col("amount_text"))
    reason = (
        F.when(posted.isNull(), "unreadable date")
        .when(parsed.isNull(), "unreadable amount")
        .when(amount == 0, "zero amount")
        .otherwise("valid")
    )
    return shape(
        rows.select(reason.alias("outcome"), amount.alias("amount"))
        .groupBy("outcome")
        .agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))
    )


def _write_exports(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Export files made from all orders, one folder per institution."""
    base = run_dir(spark, "exports")
    rows = _raw_texts(spark, sf_dir)
    number = F.col("o_custkey").cast("string")
    merchant = (
        F.when(F.col("o_custkey") % 5 == 1, F.concat(F.lit('JOE "THE" '), number, F.lit(", NYC")))
        .when(F.col("o_custkey") % 5 == 2, F.concat(F.lit("Merchant\n"), number))
        .otherwise(F.concat(F.lit("Merchant "), number))
    )
    memo = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))
    layouts = {
        "chase": [
            F.col("date_text").alias("Transaction Date"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("Post Date"),
            merchant.alias("Description"),
            F.lit("Shopping").alias("Category"),
            F.lit("Sale").alias("Type"),
            F.col("amount_text").alias("Amount"),
            memo.alias("Memo"),
        ],
        "amex": [
            F.col("date_text").alias("Date"),
            merchant.alias("Description"),
            F.lit("Travel").alias("Category"),
            F.col("amount_text").alias("Amount"),
            memo.alias("Reference"),
        ],
        "wells_fargo": [
            F.col("date_text").alias("Date"),
            merchant.alias("Description"),
            F.col("amount_text").alias("Amount"),
            F.concat(F.lit("debit "), memo).alias("Type"),
            F.col("o_totalprice").cast("decimal(15,2)").alias("Balance"),
        ],
        # the same statement with its columns in another order, and one more
        "bank_of_america": [
            F.col("o_totalprice").cast("decimal(15,2)").alias("Balance"),
            F.concat(F.lit("online "), memo).alias("Type"),
            F.col("date_text").alias("Date"),
            F.lit("branch 7").alias("Branch"),
            F.col("amount_text").alias("Amount"),
            merchant.alias("Description"),
        ],
        "generic": [
            F.col("date_text").alias("Date"),
            merchant.alias("Description"),
            F.col("amount_text").alias("Amount"),
            memo.alias("Category"),
        ],
    }
    for key, columns in layouts.items():
        rows.select(*columns).write.csv(f"{base}/{key}", header=True, escape='"')
    rows.select(F.col("date_text").alias("Date"), memo.alias("Description")).coalesce(1).write.csv(f"{base}/broken", header=True)
    return {key: f"{base}/{key}" for key in [*layouts, "broken"]}


def _ingested(spark: SparkSession, sf_dir: str) -> exports.Ingest:
    """Exports of five institutions, and among them a missing file and files without an amount."""
    paths = _write_exports(spark, sf_dir)
    broken = paths.pop("broken")
    files = {**paths, "amex": [paths["amex"], broken], "chase": [paths["chase"], f"{paths['chase']}/missing.csv"]}
    return exports.ingest(spark, files, BATCH_AT)


BATCH_AT = datetime(2001, 8, 2, 12, 0, 0)


@query
def ingest_csv(spark, sf_dir):
    """All orders written as export files and scanned back as text."""
    paths = _write_exports(spark, sf_dir)
    rows, _ = exports.read_export(spark, paths["chase"], exports.SPECS["chase"])
    return rows.drop("source_file")


@query
def ingest_mapped(spark, sf_dir):
    """Export files of five institutions through mapping, standardising and dedup."""
    return shape(exports.to_contract(_ingested(spark, sf_dir).valid))


@query
def ingest_quarantine(spark, sf_dir):
    rejected = _ingested(spark, sf_dir).rejected
    return rejected.groupBy("institution", "reject_reason").agg(F.count("*").alias("rows"))


@query
def ingest_failures(spark, sf_dir):
    """Files that could not be read at all, while the others load."""
    result = _ingested(spark, sf_dir)
    loaded = result.valid.groupBy("institution").agg(F.count("*").alias("loaded"))
    failed = result.failures.groupBy("institution", "reason").agg(F.count("*").alias("files"))
    return failed.join(loaded, "institution", "left")


@query
def raw_append(spark, sf_dir):
    """Append to a raw table twice; the second load overlaps the first and adds only what is new."""
    raw = derived.raw_ledger(spark, sf_dir)
    path = run_dir(spark, "raw")
    table = materialize.PartitionedMart(spark, path, "posted_at")
    table.append(raw.filter(F.col("posted_at") < F.lit("2000-01-01").cast("timestamp_ntz")), "txn_id")
    table.append(raw, "txn_id")
    return shape(table.read())


# --- staging ----------------------------------------------------------------


@query
def stg_merchant(spark, sf_dir):
    named = staging.normalise_merchants(
        derived.raw_ledger(spark, sf_dir), derived.ledger_categories(spark), derived.LEDGER_RULES
    )
    return named.select("txn_id", "merchant_raw", "merchant_clean", "category_std")


@query
def stg_merchant_table(spark, sf_dir):
    """Merchants cleaned by a table of rules: one for each customer's shop, longer numbers first, beside the usual ones."""
    customers = derived.read(spark, sf_dir, "customer")
    number = F.col("c_custkey").cast("string")
    shops = customers.select(
        (F.col("c_custkey") + 1000).cast("int").alias("rule_id"),
        F.concat(F.lit("SHOP "), number).alias("pattern"),
        F.concat(F.lit("Shop of customer "), number).alias("merchant_clean"),
        F.lit("7300").alias("mcc"),
        F.lit("Professional Services").alias("category_std"),
        F.lit(False).alias("risk_flag"),
        (F.lit(30) - F.length(number)).cast("int").alias("priority"),
    )
    rules = spark.createDataFrame(derived.LEDGER_RULES, MERCHANT_RULE).where("merchant_clean is not null").union(shops)
    named = staging.normalise_merchants(derived.raw_ledger(spark, sf_dir), derived.ledger_categories(spark), rules)
    return named.select("txn_id", "merchant_raw", "merchant_clean", "category_std")


@query
def stg_fx(spark, sf_dir):
    rows = staging.convert_currency(derived.raw_ledger(spark, sf_dir), derived.fx_rates(spark, sf_dir))
    return shape(rows.select("txn_id", "currency", "amount", "amount_usd", "amount_ccy"))


@query
def stg_flags(spark, sf_dir):
    return shape(
        derived.staged(spark, sf_dir).select(
            "txn_id",
            "sign",
            "abs_amount",
            "is_debit",
            "month",
            "week",
            "is_income",
            "is_expense",
            "is_transfer",
            "is_investment",
        )
    )


@query
def running_balance(spark, sf_dir):
    return shape(derived.ledger(spark, sf_dir).select("txn_id", "account_id", "posted_at", "amount", "balance_after"))


# Rows of a key beyond which the split variants cut it; they hold the same rows as the plain queries.
SPLIT_ROWS, SPLIT_BLOCK = 100, 64


@query
def running_balance_split(spark, sf_dir):
    """Running balances with every large account cut into pieces."""
    rows = staging.running_balance(derived.raw_ledger(spark, sf_dir), derived.OPENING_BALANCE, max_group_rows=SPLIT_ROWS)
    return shape(rows.select("txn_id", "account_id", "posted_at", "amount", "balance_after"))


@query
def category_rollup(spark, sf_dir):
    return shape(staging.category_rollup(derived.staged(spark, sf_dir), derived.ledger_categories(spark)))


@query
def category_rollup_deep(spark, sf_dir):
    """Orders rolled up from customers over nations to regions, as categories of three levels."""
    name = lambda c: F.col(c).alias("name")
    none, income = F.lit(None).cast("long").alias("parent_id"), F.lit(False).alias("is_income")
    region = derived.read(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("category_id"), none, name("r_name"), F.concat(F.lit("in "), F.col("r_name")).alias("budget_group"), income)
    nation = derived.read(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).cast("long").alias("category_id"), F.col("n_regionkey").cast("long").alias("parent_id"), name("n_name"), F.lit("nation").alias("budget_group"), income)
    customer = derived.read(spark, sf_dir, "customer").select((F.col("c_custkey") + 1000).alias("category_id"), (F.col("c_nationkey") + 100).cast("long").alias("parent_id"), name("c_name"), F.lit("customer").alias("budget_group"), income)
    orders = derived.read(spark, sf_dir, "orders").join(derived.read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    stg = orders.select(F.col("c_name").alias("category_std"), F.col("o_totalprice").cast("decimal(15,2)").alias("amount_usd"))
    return shape(staging.category_rollup(stg, region.union(nation).union(customer)))


# --- marts ------------------------------------------------------------------

RATES = [f"savings_rate_{s}d_avg" for s in cashflow.SPANS]


@query
def cashflow_daily(spark, sf_dir):
    return shape(_daily(spark, sf_dir), RATES)


@query
def cashflow_monthly(spark, sf_dir):
    flows = [f"{m}_{s}d_avg" for m in ("income", "expenses") for s in cashflow.SPANS]
    return shape(_monthly(spark, sf_dir), [*RATES, *flows, "avg_savings_rate"])


@query
def net_worth(spark, sf_dir):
    return shape(_net_worth(spark, sf_dir))


@query
def budget_vs_actual(spark, sf_dir):
    return shape(_budget(spark, sf_dir), [f"variance_pct_{s}m_avg" for s in (3, 6, 12)])


@query
def budget_from_table(spark, sf_dir):
    """The budget mart with targets from a table."""
    stg = settle(derived.staged(spark, sf_dir), "staged")
    return shape(budget.budget_vs_actual(stg, settle(budget.targets(stg), "targets")), [f"variance_pct_{s}m_avg" for s in (3, 6, 12)])


@query
def budget_targets(spark, sf_dir):
    return shape(budget.targets(derived.staged(spark, sf_dir)))


RECURRING_STATS = [
    "avg_interval_days",
    "interval_stddev",
    "interval_cv",
    "avg_amount",
    "amount_stddev",
    "amount_cv",
    "expected_min_amount",
    "expected_max_amount",
]


def _recurring_query(spark, sf_dir):
    return shape(_recurring(spark, sf_dir), RECURRING_STATS)


QUERIES["recurring"] = _recurring_query

SCORES = [
    "anomaly_score",
    "category_z_score",
    "merchant_z_score",
    "category_std_amount_30d",
    "merchant_std_amount_30d",
]


@query
def anomaly_score(spark, sf_dir):
    rows = _anomalies(spark, sf_dir).drop("acknowledged_at", "acknowledged_by")
    return shape(rows, SCORES)


@query
def anomaly_score_split(spark, sf_dir):
    """The same scores with every large category and merchant cut into blocks."""
    rows = anomalies.anomaly_score(derived.staged(spark, sf_dir), max_group_rows=SPLIT_ROWS, block_rows=SPLIT_BLOCK)
    return shape(rows.drop("acknowledged_at", "acknowledged_by"), SCORES)


@query
def anomaly_score_events(spark, sf_dir):
    """The same scoring over events: five categories hold all rows."""
    rows = anomalies.anomaly_score(derived.event_spend(spark, sf_dir))
    return shape(rows.drop("acknowledged_at", "acknowledged_by"), SCORES)


# Fences of cents have up to five decimals.
FENCES = ["q1", "q3", "lower_fence", "upper_fence"]


@query
def category_fences(spark, sf_dir):
    return shape(anomalies.category_fences(derived.staged(spark, sf_dir)), FENCES, 6)


@query
def anomaly_iqr(spark, sf_dir):
    return shape(anomalies.anomaly_iqr(derived.event_spend(spark, sf_dir)), FENCES, 6)


FORECAST_STATS = ["forecast_amount", "lower_bound", "upper_bound", "confidence_level", "volatility"]


@query
def forecast(spark, sf_dir):
    return shape(_forecast(spark, sf_dir), [*FORECAST_STATS, "forecast_range", "forecast_precision"])


@query
def forecast_linear(spark, sf_dir):
    rows = forecasts.forecast_linear(_simple(spark, sf_dir), derived.ledger_categories(spark), AS_OF)
    return shape(rows, ["forecast_amount", "lower_bound", "upper_bound"])


@query
def forecast_backtest(spark, sf_dir):
    return shape(forecasts.forecast_backtest(derived.staged(spark, sf_dir)), ["rmse", "mape"])


@query
def mart_cashflow_daily(spark, sf_dir):
    return shape(simple_marts.mart_cashflow_daily(_simple(spark, sf_dir)))


@query
def mart_cashflow_monthly(spark, sf_dir):
    return shape(simple_marts.mart_cashflow_monthly(_simple(spark, sf_dir)))


@query
def mart_budget(spark, sf_dir):
    return shape(simple_marts.mart_budget(_simple(spark, sf_dir), simple_categories(spark)))


@query
def mart_recurring(spark, sf_dir):
    rows = simple_marts.mart_recurring(_simple(spark, sf_dir), AS_OF)
    return shape(rows, ["amount_stddev", "avg_days_between"])


@query
def mart_forecasts(spark, sf_dir):
    rows = simple_marts.mart_forecasts(_simple(spark, sf_dir), simple_categories(spark), AS_OF)
    stats = ["forecast_amount", "lower_bound", "upper_bound", "avg_monthly_expense", "monthly_growth_rate"]
    return shape(rows, [*stats, "expense_volatility"])


@query
def anomaly_daily_z(spark, sf_dir):
    rows = simple_marts.anomaly_daily_z(_simple(spark, sf_dir))
    return shape(rows, ["avg_amount", "std_amount", "z_score"])


@query
def anomaly_daily_z_events(spark, sf_dir):
    rows = simple_marts.anomaly_daily_z(staging.simple_view(derived.event_spend(spark, sf_dir)))
    return shape(rows, ["avg_amount", "std_amount", "z_score"])


@query
def novel_merchant_90d(spark, sf_dir):
    rows = simple_marts.novel_merchant_90d(_simple(spark, sf_dir))
    return rows.select("txn_id", "posted_at", "merchant_norm", "anomaly_type", "severity", "driver")


@query
def mart_anomalies(spark, sf_dir):
    return simple_marts.mart_anomalies(_simple(spark, sf_dir)).drop("id")


@query
def anomaly_pop_z(spark, sf_dir):
    return shape(simple_marts.anomaly_pop_z(_simple(spark, sf_dir), AS_OF), ["z_score"])


@query
def anomaly_pop_z_events(spark, sf_dir):
    simple = staging.simple_view(derived.event_spend(spark, sf_dir))
    return shape(simple_marts.anomaly_pop_z(simple, derived.EVENTS_AS_OF), ["z_score"])


@query
def novel_merchant_30d(spark, sf_dir):
    return simple_marts.novel_merchant_30d(_simple(spark, sf_dir), AS_OF)


# --- reports ----------------------------------------------------------------


@query
def kpis(spark, sf_dir):
    return shape(reports.kpis(_monthly(spark, sf_dir), PERIOD), ["change_pct", "value"])


@query
def kpis_account(spark, sf_dir):
    rows = reports.kpis(_monthly(spark, sf_dir), PERIOD, account="bank_checking_2")
    return shape(rows, ["change_pct", "value"])


@query
def category_kpi(spark, sf_dir):
    return shape(reports.category_kpi(_budget(spark, sf_dir), PERIOD, "Transportation"), ["change_pct"])


def _cashflow_rows(spark, sf_dir, grain):
    return reports.cashflow(_daily(spark, sf_dir), AS_OF, grain)


@query
def cashflow_weekly(spark, sf_dir):
    return shape(_cashflow_rows(spark, sf_dir, "weekly"), ["savings_rate"])


@query
def cashflow_by_day(spark, sf_dir):
    return shape(_cashflow_rows(spark, sf_dir, "daily"), ["savings_rate"])


@query
def cashflow_by_month(spark, sf_dir):
    return shape(_cashflow_rows(spark, sf_dir, "month"), ["savings_rate"])


@query
def cashflow_totals(spark, sf_dir):
    rows = reports.cashflow_totals(_cashflow_rows(spark, sf_dir, "month"))
    return shape(rows, ["overall_savings_rate"])


@query
def budget_month(spark, sf_dir):
    return shape(reports.budget_month(_budget(spark, sf_dir), PERIOD))


@query
def budget_month_totals(spark, sf_dir):
    return shape(reports.budget_totals(reports.budget_month(_budget(spark, sf_dir), PERIOD)))


@query
def anomalies_recent(spark, sf_dir):
    return reports.anomalies_recent(_anomalies(spark, sf_dir), 50, "medium")


@query
def anomalies_recent_stored(spark, sf_dir):
    """The same report over the exported mart, of which the newest months are read."""
    path = run_dir(spark, "anomalies")
    materialize.export_parquet(_anomalies(spark, sf_dir), path)
    return reports.anomalies_recent_stored(spark, path, 50, "medium")


@query
def anomaly_totals(spark, sf_dir):
    return reports.anomaly_totals(_anomalies(spark, sf_dir))


def _ack_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acknowledgements derived from the orders: filled orders are acknowledged, urgent ones reopened later."""
    o = derived.read(spark, sf_dir, "orders")
    txn = F.sha2(F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")), 256)
    user = F.concat(F.lit("user_"), (F.col("o_custkey") % 3).cast("string"))

    def entries(rows: DataFrame, acknowledged: bool, days: int) -> DataFrame:
        at = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(days))
        return rows.select(
            txn.alias("txn_id"),
            F.lit(acknowledged).alias("acknowledged"),
            at.alias("acknowledged_at"),
            user.alias("acknowledged_by"),
        )

    done = entries(o.filter(F.col("o_orderstatus") == "F"), True, 2)
    reopened = entries(o.filter(F.col("o_orderpriority") == "1-URGENT"), False, 3)
    return done.unionByName(reopened)


@query
def anomaly_ack(spark, sf_dir):
    rows = anomalies.acknowledge(_anomalies(spark, sf_dir), _ack_log(spark, sf_dir))
    return rows.select("txn_id", "severity", "acknowledged", "acknowledged_at", "acknowledged_by")


@query
def forecast_summary(spark, sf_dir):
    return shape(reports.forecasts(_forecast(spark, sf_dir), "3_months"), FORECAST_STATS)


@query
def forecast_totals(spark, sf_dir):
    rows = reports.forecast_totals(reports.forecasts(_forecast(spark, sf_dir), "3_months"))
    return shape(rows, ["total_forecast_amount", "average_confidence"])


@query
def recurring_confirmed(spark, sf_dir):
    return shape(reports.recurring_confirmed(_recurring(spark, sf_dir)), ["avg_amount"])


@query
def recurring_totals(spark, sf_dir):
    rows = reports.recurring_totals(reports.recurring_confirmed(_recurring(spark, sf_dir)))
    return shape(rows, ["total_recurring_amount"])


@query
def net_worth_trend(spark, sf_dir):
    return shape(reports.net_worth_trend(_net_worth(spark, sf_dir), AS_OF))


@query
def savings_drivers(spark, sf_dir):
    stg = _stored(spark, sf_dir)
    monthly = cashflow.cashflow_monthly(cashflow.cashflow_daily(stg))
    rows = reports.savings_drivers(monthly, budget.budget_vs_actual(stg), PERIOD)
    return shape(rows, ["impact_pct", "variance_pct"])


@query
def explain_savings(spark, sf_dir):
    stg = _stored(spark, sf_dir)
    monthly = cashflow.cashflow_monthly(cashflow.cashflow_daily(stg))
    rows = reports.explain_savings(monthly, budget.budget_vs_actual(stg), PERIOD)
    return shape(rows, ["savings_rate", "total_savings"])


@query
def platform_summary(spark, sf_dir):
    raw = derived.raw_ledger(spark, sf_dir)
    stg = _stored(spark, sf_dir, with_balance=False)
    return reports.platform_summary(raw, anomalies.anomaly_score(stg), forecasts.forecast(stg, AS_OF), AS_OF)


@query
def bench_daily(spark, sf_dir):
    return shape(reports.daily_since(simple_marts.mart_cashflow_daily(_simple(spark, sf_dir)), date(2000, 1, 1)))


@query
def bench_category(spark, sf_dir):
    return shape(reports.category_totals(_budget(spark, sf_dir), "2000-01"))


@query
def bench_monthly(spark, sf_dir):
    rows = reports.monthly_trends(simple_marts.mart_cashflow_monthly(_simple(spark, sf_dir)), "2000-01")
    return shape(rows)


@query
def account_balances(spark, sf_dir):
    return shape(networth.account_balances(derived.ledger(spark, sf_dir)))


@query
def net_worth_carried(spark, sf_dir):
    """Net worth over all accounts known by a date, idle ones with their last balance."""
    stg = derived.staged(spark, sf_dir, with_balance=True)
    return shape(networth.net_worth(stg, derived.fx_rates(spark, sf_dir), carry_forward=True))


@query
def account_balance_totals(spark, sf_dir):
    return shape(reports.balance_totals(networth.account_balances(derived.ledger(spark, sf_dir))))


# --- materialisation --------------------------------------------------------

CUT = "2000-12-31"
RECORDS_PER_FILE = 250_000  # a compressed file is read by one task


def _exported(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All marts, written by year and month; their folders by name."""
    stg = settle(derived.staged(spark, sf_dir, with_balance=True), "staged")
    simple, categories = staging.simple_view(stg), simple_categories(spark)
    marts = {
        "cashflow_by_account": cashflow.cashflow_daily(stg),
        "cashflow_daily": simple_marts.mart_cashflow_daily(simple),
        "cashflow_monthly": simple_marts.mart_cashflow_monthly(simple),
        "budget": simple_marts.mart_budget(simple, categories),
        "anomalies": simple_marts.mart_anomalies(simple),
        "recurring": simple_marts.mart_recurring(simple, AS_OF),
        "forecasts": simple_marts.mart_forecasts(simple, categories, AS_OF),
        "anomaly_scores": anomalies.anomaly_score(stg),
        "net_worth": networth.net_worth(stg, derived.fx_rates(spark, sf_dir)),
    }
    return materialize.export_marts(marts, run_dir(spark, "marts"))


@query
def incr_highwater(spark, sf_dir):
    """Days newer than what a stored mart holds."""
    daily = settle(simple_marts.mart_cashflow_daily(_simple(spark, sf_dir)), "daily")
    mart = materialize.PartitionedMart(spark, run_dir(spark, "daily"), "date")
    mart.upsert(daily.filter(F.col("date") <= F.lit(CUT).cast("date")), ["date"])
    return shape(mart.newer(daily))


@query
def incr_month(spark, sf_dir):
    """Months newer than what a stored mart holds."""
    monthly = settle(simple_marts.mart_cashflow_monthly(_simple(spark, sf_dir)), "monthly")
    mart = materialize.PartitionedMart(spark, run_dir(spark, "monthly"), "month")
    mart.upsert(monthly.filter(F.col("month") <= CUT[:7]), ["month"])
    return mart.newer(monthly).groupBy("month").agg(F.count("*").alias("rows"))


@query
def incr_posted_at(spark, sf_dir):
    """Transactions posted after the newest one that a stored table holds."""
    raw = derived.raw_ledger(spark, sf_dir)
    mart = materialize.PartitionedMart(spark, run_dir(spark, "posted"), "posted_at")
    mart.upsert(raw.filter(F.col("posted_at") < F.lit(CUT).cast("timestamp_ntz")), ["txn_id"])
    return shape(mart.newer(raw))


@query
def incr_moved_keys(spark, sf_dir):
    """A table stored by month in which a batch moves transactions to a later one; a replay and an append change nothing."""
    raw = derived.raw_ledger(spark, sf_dir)
    moved = raw.filter(F.col("txn_id") < "1a").withColumns(
        {"posted_at": F.col("posted_at") + F.expr("INTERVAL 45 DAYS"), "amount": (F.col("amount") + 1).cast("decimal(15,2)")}
    )
    mart = materialize.PartitionedMart(spark, run_dir(spark, "moved"), "posted_at")
    for batch in (raw, moved, moved):
        mart.upsert(batch, ["txn_id"])
    mart.append(raw, "txn_id")
    return shape(mart.read())


@query
def incr_upsert(spark, sf_dir):
    """Old days, replaced from December 2000 on by rows that carry one more column."""
    daily = settle(simple_marts.mart_cashflow_daily(_simple(spark, sf_dir)).select("date", "income", "expenses"), "daily")
    loaded = daily.filter(F.col("date") <= F.lit(CUT).cast("date"))
    corrected = daily.filter(F.col("date") >= F.lit("2000-12-01").cast("date")).withColumn("revision", F.lit(2))
    mart = materialize.PartitionedMart(spark, run_dir(spark, "daily"), "date")
    for batch in (loaded, corrected, corrected):  # the last is a replay
        mart.upsert(batch, ["date"])
    return shape(mart.read())


@query
def export_parquet(spark, sf_dir):
    """The daily mart written by year and month, and read back with its partition columns."""
    path = run_dir(spark, "cashflow_daily")
    materialize.export_parquet(simple_marts.mart_cashflow_daily(_simple(spark, sf_dir)), path)
    return shape(spark.read.parquet(path))


@query
def export_report(spark, sf_dir):
    """The monthly cashflow report over the exported daily mart."""
    daily = spark.read.parquet(_exported(spark, sf_dir)["cashflow_by_account"])
    return shape(reports.cashflow(daily, AS_OF, "month"), ["savings_rate"])


@query
def summary_stats(spark, sf_dir):
    """Row counts and bounds of the views over the exported marts."""
    paths = _exported(spark, sf_dir)
    materialize.register_views(spark, {f"mart_{name}": path for name, path in paths.items()})
    labels = {
        "Daily Cashflow": ("cashflow_daily", "date"),
        "Monthly Cashflow": ("cashflow_monthly", "month"),
        "Budget Variance": ("budget", "month"),
    }
    return materialize.summary_stats({label: (spark.table(f"mart_{name}"), bound) for label, (name, bound) in labels.items()})


@query
def summary_marts(spark, sf_dir):
    """Rows of every exported mart."""
    paths = _exported(spark, sf_dir)
    counted = [spark.read.parquet(p).agg(F.count("*").alias("rows")).select(F.lit(n).alias("mart"), "rows") for n, p in paths.items()]
    return reduce(DataFrame.unionAll, counted)


def _streamed(spark: SparkSession, sf_dir: str, merge: bool = False) -> tuple[str, str]:
    """Folders of the table and the quarantine after a stream of three arrivals.

    First come the newer rows, a tenth of them still drafts; then an older backfill and the corrected drafts; then
    records that break the contract, and repeats. Arrivals come compressed and go once they are ingested.
    """
    inbox, target, quarantine, state = (run_dir(spark, n) for n in ("inbox", "ledger", "quarantine", "ingest-state"))
    raw = derived.raw_ledger(spark, sf_dir).withColumn("balance_after", F.lit(None).cast("decimal(15,2)"))
    newer = F.col("posted_at") >= F.lit("2000-01-01").cast("timestamp_ntz")
    draft = F.col("txn_id") < "1a"
    as_draft = raw.withColumns({"amount": F.lit(1).cast("decimal(15,2)"), "merchant_raw": F.lit("DRAFT")})
    broken = raw.withColumn("currency", F.lower("currency")).filter(F.col("txn_id") < "08")
    arrivals = [
        raw.filter(newer & ~draft).unionByName(as_draft.filter(newer & draft)),
        raw.filter(~newer).unionByName(raw.filter(draft)),
        broken.unionByName(raw.filter(F.col("txn_id") > "f0")),
    ]
    for arrival in arrivals:
        writer = arrival.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
        writer.option("maxRecordsPerFile", RECORDS_PER_FILE).json(inbox, compression="gzip")
        stream_ingest.run_ingest(spark, inbox, target, quarantine, state).awaitTermination()
        materialize.remove(spark, inbox)
        if merge:
            stream_ingest.merge_batches(spark, target)
    return target, quarantine


def _stream_ingest(spark, sf_dir):
    target, _ = _streamed(spark, sf_dir)
    return shape(stream_ingest.current_rows(spark, target))


QUERIES["stream_ingest"] = _stream_ingest


@query
def stream_compacted(spark, sf_dir):
    """The same stream with a merge of its batches after each arrival, a repeated merge, and merged batches removed."""
    target, _ = _streamed(spark, sf_dir, merge=True)
    stream_ingest.merge_batches(spark, target)
    compaction.discard_merged(spark, target)
    return shape(stream_ingest.current_rows(spark, target))


@query
def stream_quarantine(spark, sf_dir):
    """Records that the stream set aside, by reason."""
    _, quarantine = _streamed(spark, sf_dir)
    rows = spark.read.parquet(quarantine)
    return rows.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@query
def stream_metrics_daily(spark, sf_dir):
    """Daily metric summaries, computed as a stream over the events, a tenth of which come late, in a second run."""
    inbox, target, state = (run_dir(spark, n) for n in ("events", "metrics", "metrics-state"))
    events = derived.read(spark, sf_dir, "events")
    late = F.col("event_id") % 10 == 0
    for arrival in (events.filter(~late), events.filter(late)):
        arrival.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        stream_metrics.run_summary(spark, stream, target, state, "1 day").awaitTermination()
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return shape(stream_metrics.current_windows(spark, target).withColumns(bounds), ["avg"])


# --- data quality -----------------------------------------------------------


def _quality_rows(results: DataFrame) -> DataFrame:
    return shape(results, ["score"])


def _raw_with_balance(spark, sf_dir):
    return derived.ledger(spark, sf_dir)


def _raw_checks(spark, sf_dir, names: set[str]) -> DataFrame:
    checks = [c for c in quality.raw_suite() if c.name in names]
    return _quality_rows(quality.run_suite(_raw_with_balance(spark, sf_dir), "raw", checks))


@query
def dq_not_null(spark, sf_dir):
    return _raw_checks(spark, sf_dir, {"not_null"})


@query
def dq_unique(spark, sf_dir):
    return _raw_checks(spark, sf_dir, {"unique"})


@query
def dq_duplicate_rows(spark, sf_dir):
    """Line items are not unique by order and line number: the keys that repeat."""
    items = derived.read(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(items, "l_orderkey", "l_linenumber")


@query
def dq_range(spark, sf_dir):
    return _raw_checks(spark, sf_dir, {"range"})


@query
def dq_accepted(spark, sf_dir):
    return _raw_checks(spark, sf_dir, {"accepted_values"})


@query
def dq_regex(spark, sf_dir):
    return _raw_checks(spark, sf_dir, {"regex"})


@query
def dq_no_pii(spark, sf_dir):
    """Free text must not hold card numbers."""
    docs = derived.read(spark, sf_dir, "documents")
    return _quality_rows(quality.run_suite(docs, "documents", [quality.not_matches("text", quality.CARD_PATTERN)]))


@query
def dq_row_count(spark, sf_dir):
    counted = [
        quality.row_count_between(derived.read(spark, sf_dir, t), t, 1, 10_000_000)
        for t in ("orders", "customer", "lineitem", "events")
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return _quality_rows(quality.score(result))


@query
def dq_contract(spark, sf_dir):
    """Contract violations of records with damaged fields, by reason."""
    raw = derived.raw_ledger(spark, sf_dir).join(
        derived.read(spark, sf_dir, "orders").select(
            F.sha2(F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")), 256).alias("txn_id"),
            "o_orderpriority",
        ),
        "txn_id",
    )
    p = F.col("o_orderpriority")
    damaged = raw.withColumns(
        {
            "source": F.when(p == "1-URGENT", "cash").otherwise(F.col("source")),
            "currency": F.when(p == "2-HIGH", F.lower("currency")).otherwise(F.col("currency")),
            "account_id": F.when(p == "3-MEDIUM", F.lit(None)).otherwise(F.col("account_id")),
        }
    )
    _, bad = contract.split_valid(damaged)
    return bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@query
def dq_zero(spark, sf_dir):
    return _raw_checks(spark, sf_dir, {"non_zero"})


@query
def dq_fk(spark, sf_dir):
    """Orders to customers holds; orders to customers in credit does not."""
    orders, customer = derived.read(spark, sf_dir, "orders"), derived.read(spark, sf_dir, "customer")
    in_credit = customer.filter("c_acctbal >= 0")
    whole = quality.foreign_key(orders, customer, "orders->customer", "o_custkey", "c_custkey")
    partial = quality.foreign_key(orders, in_credit, "orders->customer in credit", "o_custkey", "c_custkey")
    return _quality_rows(whole.unionByName(partial))


def _wrong_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger whose urgent orders carry a wrong balance."""
    urgent = F.col("description_raw").endswith("1-URGENT")
    balance = F.when(urgent, F.col("balance_after") + 1).otherwise(F.col("balance_after"))
    return derived.ledger(spark, sf_dir).withColumn("balance_after", balance.cast("decimal(18,2)"))


@query
def dq_balance(spark, sf_dir):
    return shape(quality.balance_breaks(_wrong_balances(spark, sf_dir)))


@query
def dq_balance_split(spark, sf_dir):
    """The same breaks with every large account cut into blocks."""
    return shape(quality.balance_breaks(_wrong_balances(spark, sf_dir), SPLIT_ROWS, SPLIT_BLOCK))


@query
def dq_keys(spark, sf_dir):
    """Foreign keys of the marts: categories, budget, anomalies and forecasts."""
    categories = derived.ledger_categories(spark)
    names = categories.select("name")
    above = categories.select(F.col("category_id").alias("up"), F.col("name").alias("parent"))
    parents = categories.join(above, F.col("parent_id") == F.col("up"), "left")
    stg = settle(derived.staged(spark, sf_dir), "staged")
    found = [
        quality.foreign_key(parents.select("parent"), names, "categories", "parent", "name"),
        quality.foreign_key(budget.budget_vs_actual(stg), names, "budget", "category_name", "name"),
        quality.foreign_key(anomalies.anomaly_score(stg), stg, "anomalies", "txn_id", "txn_id"),
        quality.foreign_key(forecasts.forecast(stg, AS_OF), names, "forecasts", "category_name", "name"),
    ]
    return _quality_rows(reduce(DataFrame.unionByName, found))


@query
def dq_schema(spark, sf_dir):
    """Types, columns and row count of the raw ledger; two of the expectations don't hold."""
    raw = derived.raw_ledger(spark, sf_dir)
    wanted = quality.Shape(
        types={"txn_id": ["string"], "amount": ["decimal", "double"], "posted_at": ["timestamp", "timestamp_ntz"]},
        ordered=sorted(raw.columns),
        least=["txn_id", "amount"],
        rows=(1, 10_000_000),
    )
    exact = quality.Shape(types={"amount": ["double"]})
    return _quality_rows(
        quality.score(quality.shape_failures(raw, "raw", wanted).unionByName(quality.shape_failures(raw, "raw", exact)))
    )


def _checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, staging and mart suites in one result; every table is computed and stored once."""
    raw = settle(_raw_with_balance(spark, sf_dir), "raw")
    fx = derived.fx_rates(spark, sf_dir)
    stg = settle(staging.stage(raw, fx, derived.ledger_categories(spark), derived.LEDGER_RULES), "staged")
    daily = settle(cashflow.cashflow_daily(stg), "daily")
    marts = {
        "cashflow_daily": daily,
        "cashflow_monthly": cashflow.cashflow_monthly(daily),
        "net_worth": networth.net_worth(stg, fx),
        "budget_vs_actual": budget.budget_vs_actual(stg),
        "anomalies": anomalies.anomaly_score(stg),
        "forecasts": forecasts.forecast(stg, AS_OF),
        "recurring": _recurring(spark, sf_dir),
    }
    suites = [
        ("raw", raw, quality.raw_suite()),
        ("staging", stg, quality.staging_suite()),
        *[(name, marts[name], checks) for name, checks in quality.mart_suites().items()],
    ]
    return quality.run_checkpoint(suites)


@query
def dq_report(spark, sf_dir):
    return _quality_rows(_checkpoint(spark, sf_dir))


@query
def dq_summary(spark, sf_dir):
    """Passed and total checks of every table of the checkpoint."""
    return shape(quality.checkpoint_summary(_checkpoint(spark, sf_dir)), ["quality_score"])


# --- privacy, audit, metrics ------------------------------------------------


@query
def pii_redact(spark, sf_dir):
    docs = derived.read(spark, sf_dir, "documents").select("doc_id", "text")
    return privacy.redact_columns(docs, ["text"])


@query
def pii_redact_names(spark, sf_dir):
    turns = derived.read(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return privacy.redact_columns(turns, ["text"], log_style=True)


@query
def pii_scan(spark, sf_dir):
    return privacy.pii_scan(derived.read(spark, sf_dir, "documents"), "text", "lang")


@query
def pii_redact_map(spark, sf_dir):
    """Nested records: a map and a list of texts per document."""
    docs = derived.read(spark, sf_dir, "documents")
    record = F.create_map(F.lit("text"), F.col("text"), F.lit("source"), F.col("source"))
    nested = F.create_map(F.lit("body"), record)
    redacted = pii.redact_nested(nested)
    lines = pii.redact_list(F.split("text", "\n"))
    return docs.select(
        "doc_id",
        redacted["body"]["text"].alias("text"),
        redacted["body"]["source"].alias("source"),
        F.array_join(lines, "\n").alias("lines"),
    )


@query
def hash_merchant(spark, sf_dir):
    raw = derived.raw_ledger(spark, sf_dir)
    return raw.select(
        "txn_id",
        hashing.hash_merchant(F.col("merchant_raw")).alias("merchant_hash"),
        hashing.hash_merchant(F.col("merchant_raw"), hashing.INGEST_SALT).alias("ingest_merchant_hash"),
        hashing.hash_account(F.col("account_id")).alias("account_hash"),
    )


@query
def audit_hash(spark, sf_dir):
    raw = derived.raw_ledger(spark, sf_dir)
    return raw.select("txn_id", hashing.audit_hash(["txn_id", "account_id", "amount", "currency"]).alias("audit_hash"))


@query
def audit_trail(spark, sf_dir):
    events = derived.read(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.lit("access").alias("event_type"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("action"),
        (F.col("event_type") != "error").alias("success"),
    )
    log = privacy.AuditLog(spark, run_dir(spark, "audit"))
    second = F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for token, batch in (("first", ~second), ("second", second), ("first", ~second)):  # the last is a replay
        log.append(events.filter(batch), token)
    return privacy.audit_counts(privacy.audit_trail(log.read()))


@query
def load_metrics(spark, sf_dir):
    """Rows of real loads, counted as they pass; times differ from run to run, so only their presence is shown."""
    points = []
    for name in ("orders", "events", "customer"):
        path = run_dir(spark, f"load-{name}")
        points.append(metrics.measured(derived.read(spark, sf_dir, name), lambda df, path=path: df.write.parquet(path), name, datetime(2001, 8, 2)))
    found = reduce(DataFrame.unionAll, points)
    rows = F.when(F.col("name") == "data_processing_rows", F.col("value")).alias("rows")
    return found.select("name", F.col("labels")["table"].alias("table_name"), "unit", rows, (F.col("value") > 0).alias("positive"))


@query
def metric_summary(spark, sf_dir):
    events = derived.read(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), "value", F.col("ts").alias("timestamp"), "event_id"
    )
    return shape(metrics.metric_summary(events, F.struct("timestamp", "event_id")), ["avg"])


@query
def metric_windows(spark, sf_dir):
    """Hourly summaries; the batch twin of the metrics stream."""
    points = derived.read(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), "value", F.col("ts").alias("timestamp")
    )
    return shape(metrics.windowed_summary(points, "1 hour"), ["avg"])
