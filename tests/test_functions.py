"""Column expressions on literal values."""

import hashlib
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import clean, dates, hashing, pii


def apply(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_amounts(spark):
    values = ["100.50", "$1,000.00", "-50.25", None, "", "abc", " $ 7 ", "2.345"]
    expected = ["100.50", "1000.00", "-50.25", "0", "0", "0", "7.00", "2.35"]
    assert apply(spark, clean.std_amount, values) == [Decimal(e).quantize(Decimal("0.01")) for e in expected]


def test_card_amounts_flip(spark):
    got = apply(spark, lambda c: clean.std_amount(c, True), ["12.00", "-3.00", "0"])
    assert got == [Decimal("-12.00"), Decimal("-3.00"), Decimal("0.00")]


def test_dates(spark):
    values = ["2024-01-15", "02/13/2024", "13/02/2024", "2024-02-13 10:11:12", "03/04/2024", "invalid", None, "2024-02-13T01:02:03"]
    assert apply(spark, clean.std_date, values) == [
        datetime(2024, 1, 15),
        datetime(2024, 2, 13),
        datetime(2024, 2, 13),
        datetime(2024, 2, 13, 10, 11, 12),
        datetime(2024, 3, 4),
        None,
        None,
        datetime(2024, 2, 13, 1, 2, 3),
    ]


def test_currencies(spark):
    values = ["usd", " US ", "$", "euro", "€", "uk", "£", "chf", None]
    assert apply(spark, clean.std_currency, values) == ["USD", "USD", "USD", "EUR", "EUR", "GBP", "GBP", "CHF", "USD"]


@pytest.mark.parametrize(
    "text,channel",
    [
        ("POS transaction", "pos"),
        ("Online purchase", "ecom"),
        ("ACH transfer", "ach"),
        ("Zelle payment", "zelle"),
        ("ATM cash", "atm"),
        ("Mobile deposit", "pos"),
        ("Unknown", "unknown"),
        ("", "unknown"),
        (None, "unknown"),
    ],
)
def test_channels(spark, text, channel):
    assert apply(spark, clean.detect_channel, [text]) == [channel]


def test_merchant_hash(spark):
    got = apply(spark, lambda c: hashing.hash_merchant(c, hashing.INGEST_SALT), ["Starbucks", "", None])
    assert got == [hashlib.sha256(b"Starbucksfinops_salt").hexdigest()[:16], "", None]
    assert len(apply(spark, hashing.hash_account, ["acct_1"])[0]) == 12


def test_iso_week_at_year_ends(spark):
    got = apply(spark, lambda c: dates.iso_week(c.cast("date")), ["2021-01-01", "2020-12-31", "2024-12-30", "2024-01-08"])
    assert got == ["2020-W53", "2020-W53", "2025-W01", "2024-W02"]


def test_redaction_order_and_tags(spark):
    values = [
        "card 4111-1111-1111-1111 or 4111 1111 1111 1111",
        "ssn 123-45-6789 phone 555-123-4567",
        "mail john.doe@example.com",
        "account 123456789012 and 1234567",
        None,
    ]
    assert apply(spark, pii.redact, values) == [
        "card [CREDIT_CARD] or [CREDIT_CARD]",
        "ssn [SSN] phone [PHONE]",
        "mail [EMAIL]",
        "account [ACCOUNT_NUMBER] and 1234567",
        None,
    ]
    assert apply(spark, pii.redact_log, ["John Smith paid 123456789012"]) == ["[NAME] paid 123456789012"]


def test_nested_redaction(spark):
    df = spark.createDataFrame(
        [({"a": {"x": "a@b.com"}}, ["123-45-6789", "ok"])], "m map<string,map<string,string>>, l array<string>"
    )
    row = df.select(pii.redact_nested(F.col("m")).alias("m"), pii.redact_list(F.col("l")).alias("l")).first()
    assert row["m"] == {"a": {"x": "[EMAIL]"}} and row["l"] == ["[SSN]", "ok"]


def test_audit_hash_ignores_column_order(spark):
    df = spark.createDataFrame([(1, "x", None)], "b int, a string, c string")
    one, other = hashing.audit_hash(["a", "b", "c"]), hashing.audit_hash(["c", "b", "a"])
    row = df.select(one.alias("one"), other.alias("other")).first()
    assert row["one"] == row["other"] == hashlib.sha256(b'{"a":"x","b":1,"c":null}').hexdigest()
