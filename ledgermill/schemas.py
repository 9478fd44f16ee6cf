"""Declared schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
RATE = T.DecimalType(10, 6)

RAW_TRANSACTION = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("posted_at", T.TimestampNTZType()),
        T.StructField("amount", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_raw", T.StringType()),
        T.StructField("mcc_raw", T.StringType()),
        T.StructField("description_raw", T.StringType()),
        T.StructField("category_raw", T.StringType()),
        T.StructField("counterparty_raw", T.StringType()),
        T.StructField("balance_after", MONEY),
        T.StructField("hash_raw", T.StringType()),
        T.StructField("ingest_batch_id", T.StringType()),
    ]
)

REQUIRED_RAW_COLUMNS = ("txn_id", "source", "account_id", "posted_at", "amount", "currency")

CATEGORY = T.StructType(
    [
        T.StructField("category_id", T.IntegerType()),
        T.StructField("parent_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("budget_group", T.StringType()),
        T.StructField("is_income", T.BooleanType()),
    ]
)

MERCHANT_RULE = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType()),
        T.StructField("pattern", T.StringType()),
        T.StructField("merchant_clean", T.StringType()),
        T.StructField("mcc", T.StringType()),
        T.StructField("category_std", T.StringType()),
        T.StructField("risk_flag", T.BooleanType()),
        T.StructField("priority", T.IntegerType()),
    ]
)

FX_RATE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("usd_to_eur", RATE),
        T.StructField("usd_to_gbp", RATE),
        T.StructField("usd_to_cad", RATE),
        T.StructField("usd_to_aud", RATE),
    ]
)

ACCOUNT = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("institution", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("open_dt", T.DateType()),
        T.StructField("close_dt", T.DateType()),
        T.StructField("currency", T.StringType()),
    ]
)

METRIC_POINT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

AUDIT_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("resource", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("table", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("record_count", T.LongType()),
    ]
)
