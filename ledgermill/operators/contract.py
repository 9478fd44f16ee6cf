"""The closed record contract of raw transactions, with quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.quality import CURRENCY_CODE, HEX64, SOURCES
from ledgermill.schemas import RAW_TRANSACTION, REQUIRED_RAW_COLUMNS


def check_columns(columns: list[str]) -> None:
    """Raise when required columns are missing or unknown ones are present."""
    missing = [c for c in REQUIRED_RAW_COLUMNS if c not in columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    unknown = sorted(set(columns) - set(RAW_TRANSACTION.fieldNames()))
    if unknown:
        raise ValueError(f"Unknown columns: {unknown}")


def same_order(columns: list[str], expected: list[str]) -> bool:
    return list(columns) == list(expected)


def has_columns(columns: list[str], expected: list[str]) -> bool:
    return set(expected) <= set(columns)


def has_type(df: DataFrame, column: str, types: tuple[str, ...]) -> bool:
    """Whether the column's type name is one of ``types`` (decimal without its precision)."""
    return df.schema[column].dataType.typeName() in types


def violations() -> Column:
    """Array of reasons, empty for a valid row."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c} missing")) for c in REQUIRED_RAW_COLUMNS]
    reasons += [
        F.when(~F.col("txn_id").rlike(HEX64), F.lit("txn_id pattern")),
        F.when(~F.col("source").isin(*SOURCES), F.lit("source not accepted")),
        F.when(~F.col("currency").rlike(CURRENCY_CODE), F.lit("currency pattern")),
    ]
    return F.array_compact(F.array(*reasons))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with their reasons."""
    marked = df.withColumn("reasons", violations())
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)
