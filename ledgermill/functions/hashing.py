"""Hashes of transactions and identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.schemas import MONEY

# Salts in use.
INGEST_SALT = "finops_salt"
STORE_SALT = "finops_salt_2024"


def txn_id(posted_at: Column, amount: Column, merchant: Column, description: Column, institution: Column) -> Column:
    """SHA-256 of the transaction's attributes in canonical text form."""
    return F.sha2(
        F.concat(
            F.date_format(posted_at, "yyyy-MM-dd'T'HH:mm:ss"),
            amount.cast(MONEY).cast("string"),
            merchant,
            description,
            institution,
        ),
        256,
    )


def row_hash(account_id: Column, day: Column, amount: Column) -> Column:
    """MD5 over account, date and amount: equal for repeated export rows."""
    return F.md5(F.concat_ws("_", account_id, day.cast("date").cast("string"), amount.cast(MONEY).cast("string")))


def salted(value: Column, salt: str, length: int) -> Column:
    """First ``length`` hex digits of a salted SHA-256; NULL and '' pass through."""
    hashed = F.substring(F.sha2(F.concat(value, F.lit(salt)), 256), 1, length)
    return F.when(value.isNull() | (value == ""), value).otherwise(hashed)


def hash_merchant(value: Column, salt: str = STORE_SALT) -> Column:
    return salted(value, salt, 16)


def hash_account(value: Column, salt: str = STORE_SALT) -> Column:
    return salted(value, salt, 12)


def audit_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of a record's compact JSON with its fields in name order."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)
